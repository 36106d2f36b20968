"""Configuration sections of nodes and masters. They are read by schemas.load_config: typed, and unknown keys are errors."""

from __future__ import annotations

from dataclasses import dataclass, field

from .schemas import AlignerConfig, R2SConfig

GIB = 1 << 30


@dataclass(frozen=True)
class AcquisitionNode:
    master_address: str = "127.0.0.1:50093"
    node_id: str = "acq-r2s-node-0"
    node_address: str = "127.0.0.1"
    output_root: str = "Data/raw_data"
    output_roots: tuple[str, ...] = ()
    shard_strategy: str = "RoundRobin"
    manifest_filename: str = "session_manifest.jsonl"
    session_name_prefix: str = "acq_r2s_node"
    max_file_size_mb: int = 1024
    overwrite_existing: bool = True
    reserved_storage_gib: int = 20
    status_interval_ms: int = 500
    enable_raw_file_write: bool = False
    async_queue_depth: int = 1024
    writer_threads_per_shard: int = 1
    use_spill_to_disk: bool = True
    fail_on_queue_full: bool = False
    fsync_each_segment: bool = True


@dataclass(frozen=True)
class Bridge:
    """How raw segments wait for the decoder: at most `queue_capacity`; a full queue blocks, or drops the newest."""

    enabled: bool = True
    queue_capacity: int = 256
    reserve_packets_per_slot: int = 4096
    reserve_bytes_per_slot: int = 4 << 20
    block_when_queue_full: bool = True
    queue_full_warn_every: int = 5000
    input_channel_count: int = 4


@dataclass(frozen=True)
class CoinClient:
    enabled: bool = True
    server_address: str = "127.0.0.1:50061"
    node_id: int = 0
    node_address: str = "127.0.0.1"
    channel_count: int = 4
    detector_type: str = "BDM2"
    remap_local_to_global_channels: bool = False
    global_channel_offset: int = 0
    crystals_per_channel: int = 676
    max_pending_chunks: int = 128
    batch_size: int = 1
    heartbeat_interval_ms: int = 5000
    wait_for_start_signal: bool = True
    wait_for_start_timeout_ms: int = 0
    wait_for_start_rpc_timeout_ms: int = 15000
    wait_for_start_retry_interval_ms: int = 1000


@dataclass(frozen=True)
class Node:
    acq_node: AcquisitionNode = field(default_factory=AcquisitionNode)
    r2s: R2SConfig = field(default_factory=R2SConfig)
    bridge: Bridge = field(default_factory=Bridge)
    coin_client: CoinClient = field(default_factory=CoinClient)


@dataclass(frozen=True)
class CoinMaster:
    listen_address: str = "0.0.0.0:50061"
    expected_node_count: int = 1
    auto_start_when_all_registered: bool = True
    start_lead_time_ms: int = 1000
    wait_for_start_default_timeout_ms: int = 30000
    reject_stream_before_start: bool = True
    status_print_interval_ms: int = 2000
    run_seconds: int = 0


@dataclass(frozen=True)
class AcquisitionControl:
    enabled: bool = False
    master_address: str = "127.0.0.1:50093"
    auto_distribute_when_all_connected: bool = True
    auto_start_on_coin_start_signal: bool = True
    start_duration_ms: int = 0
    acquisition_algorithm: str = "Socket"
    source_port_base: int = 17100
    destination_port_base: int = 18100
    channel_count: int = 4
    source_ip: str = "127.0.0.1"
    destination_ip: str = "127.0.0.1"
    session_name: str = "app_coin_master_session"
    storage_unit_size: int = 2048
    min_packet_size: int = 1
    max_buffer_size: int = 4 * GIB
    time_switch_buffer_ms: int = 200
    reserved_storage_gib: int = 20
    max_file_size_mb: int = 256


@dataclass(frozen=True)
class Master:
    coin_master: CoinMaster = field(default_factory=CoinMaster)
    aligner: AlignerConfig = field(default_factory=AlignerConfig)
    acq_control: AcquisitionControl = field(default_factory=AcquisitionControl)
