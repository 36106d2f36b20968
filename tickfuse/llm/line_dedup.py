"""Line deduplication by site-relative frequency, with built-in functions only.

Lines are counted once a page and grouped by host; a line whose share of its host's pages is above the boilerplate
ratio goes from every page of that host. Copies can count as one page, so that they don't make their own lines
boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, attach, free, table

#: A line in more than this share of a host's pages is boilerplate, if it is in more than one of them.
RATIO, PAGES = 0.02, 2


def trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\n\v\f\r"))


def html_lines(html: Column) -> Column:
    """The text lines of a page: scripts, styles and comments go, tags become line ends."""
    bare = F.regexp_replace(html, r"<(?:(?i:script|style)\b[^>]*>(?s:.*?)</(?i:script|style)>|!--(?s:.*?)-->)", "\n")
    return F.regexp_replace(bare, r"<[^>]*>", "\n")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def line_key(line: Column) -> list[Column]:
    """128 bits for a line; the counts need no more than that of it."""
    return [F.xxhash64(line).alias("k1"), F.xxhash64(line, F.lit(7)).alias("k2")]


def as_text(k1: Column, k2: Column) -> Column:
    """A line's key as a string, which Spark's set functions hash."""
    return F.concat(F.hex(k1), F.lit("-"), F.hex(k2))


def text_key(text: Column) -> list[Column]:
    """128 bits for the sequence of words in lower case: what near_dup takes for a copy has the same."""
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"[{SPACE}]+", " "))
    return [F.xxhash64(words).alias("t1"), F.xxhash64(words, F.lit(7)).alias("t2")]


def drop_boilerplate(pages: DataFrame, page_id: str, host: str, text: str, ratio: float = RATIO, least: int = PAGES, by_text: bool = False) -> DataFrame:
    """pages with text without its boilerplate lines, and three columns more (underscored where the name is taken):
    n_lines, n_dropped, host_pages.

    Lines are compared without white space at their ends; blank lines are never counted nor dropped. A null text stays
    null and has no line; a null host is a host of its own, and so is the empty one (URLs without a host). A text is split
    whole, and must fit into a task. host_pages counts rows, so a page that is there twice counts
    twice. With by_text a line counts once a distinct text of its host, and its share is that of the host's distinct
    texts: rows of equal words count as one, while host_pages still counts rows. Equal rows are treated alike. An empty
    table stays empty.
    """
    n_lines, n_dropped, total = (free(pages, n) for n in ("n_lines", "n_dropped", "host_pages"))
    src = pages.select(F.struct(*pages.columns).alias("__row"), F.col(host).alias("__h"), F.col(text).alias("__text"))
    # Every text has the blank line, whatever it holds: so many pages have that line as the host has pages, or texts.
    blank = F.array(F.lit(""))
    lines = F.array_union(F.coalesce(F.transform(F.split(F.col(text), "\n"), trimmed), blank), blank)
    own = text_key(F.col(text)) if by_text else []
    # The text's key goes through the generator with its lines; beside it, it would be made anew for each line.
    each = pages.select(F.col(host).alias("__h"), F.struct(*own, F.lit(0)).alias("__t"), lines.alias("__l"))
    each = each.select("__h", F.explode(F.arrays_zip("__l", F.array_repeat("__t", F.size("__l")))).alias("__e"))
    each = each.select("__h", (F.col("__e.__l") == "").alias("__b"), *line_key(F.col("__e.__l")), *[F.col("__e").getField("1").getField(t).alias(t) for t in ("t1", "t2") if by_text])
    hosts = pages.groupBy(F.col(host).alias("__h")).agg(F.count(F.lit(1)).alias("__n"))
    # Counts meet in map-side sums, hot lines and hot hosts too.
    each = each.distinct() if by_text else each
    counts = each.groupBy("__h", "__b", "k1", "k2").agg(F.count(F.lit(1)).alias("__c"))
    counts = table(counts.where((F.col("__c") >= least) | F.col("__b")), "line-counts")
    base = counts.where("__b").select("__h", F.col("__c").alias("__of"))
    common = attach(counts.where("not __b"), base, ["__h"], "inner").where(F.col("__c") > F.lit(float(ratio)) * F.col("__of")).select("__h", "k1", "k2")
    # How many there are is bounded by the pages: at most 1 / ratio lines a page could each be in so many of them.
    per_host = common.groupBy("__h").agg(F.collect_set(as_text(F.col("k1"), F.col("k2"))).alias("__common"))
    # One row a host, written first: its size is known then, and only a small one is broadcast; pages stay where they are.
    sites = table(attach(hosts, per_host, ["__h"]), "line-sites")
    out = attach(src, sites, ["__h"])
    # Each step is a projection of its own, so that a line is trimmed and hashed once. The page's boilerplate is an
    # intersection of sets, which hashes; what a line is looked up in then is no longer than the page.
    out = out.withColumn("__lines", F.transform(F.split("__text", "\n"), lambda s: F.struct(s.alias("raw"), trimmed(s).alias("bare"))))
    keys = F.transform("__lines", lambda s: F.when(s["bare"] != "", as_text(*line_key(s["bare"]))))
    out = out.withColumn("__keys", keys).withColumn("__bad", F.coalesce(F.array_intersect("__keys", "__common"), F.array().cast("array<string>")))
    # Most pages have none of it, and keep their lines as they are. (A column that is read once only, inside a lambda, would be
    # made anew for each line: the planner puts its expression there.)
    good = F.filter(F.arrays_zip("__lines", "__keys"), lambda s: s["__keys"].isNull() | ~F.array_contains(F.col("__bad"), s["__keys"]))
    out = out.withColumn("__kept", F.when(F.size("__bad") == 0, F.col("__lines")).otherwise(F.transform(good, lambda s: s["__lines"])))
    real = lambda c: F.when(F.col("__text").isNull(), F.lit(0)).otherwise(F.size(F.filter(c, lambda s: s["bare"] != ""))).cast("bigint")
    out = out.withColumns({"__n_lines": real("__lines"), "__n_kept": real("__kept")})
    new = F.when(F.col("__text").isNotNull(), F.array_join(F.transform("__kept", lambda s: s["raw"]), "\n"))
    cols = [new.alias(c) if c == text else F.col("__row").getField(c).alias(c) for c in pages.columns]
    return out.select(*cols, F.col("__n_lines").alias(n_lines), (F.col("__n_lines") - F.col("__n_kept")).alias(n_dropped), F.col("__n").alias(total))


def clean_documents(docs: DataFrame, ratio: float = RATIO, least: int = PAGES) -> DataFrame:
    """documents with source as host: the same columns, text and n_chars after the removal. Lines count by distinct text."""
    cols = docs.columns
    out = drop_boilerplate(docs, "doc_id", "source", "text", ratio, least, by_text=True)
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(cols)
