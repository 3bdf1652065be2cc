"""Rule identities and thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from decimal import Decimal


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    level: str
    reason: str


# --- fixed values: rule ids, names, levels and reasons ---------------------
R001 = Rule("R001", "用户短时高频交易", "MEDIUM", "同一用户在1分钟窗口内交易次数超过10次")
R002 = Rule("R002", "用户短时大额交易", "HIGH", "同一用户在5分钟窗口内累计交易金额超过20000元")
R003 = Rule("R003", "设备多用户关联", "HIGH", "同一设备在10分钟内关联超过5个用户")
R004 = Rule("R004", "银行卡多用户关联", "HIGH", "同一银行卡在10分钟内关联超过3个用户")
R005 = Rule("R005", "连续支付失败", "MEDIUM", "同一用户连续支付失败次数达到5次")
R006 = Rule("R006", "黑名单设备交易", "HIGH", "当前交易设备命中黑名单设备")
R007 = Rule("R007", "用户交易金额突增", "MEDIUM", "当前交易金额超过用户历史平均交易金额5倍")
R008 = Rule("R008", "商户收款突增", "HIGH", "同一商户5分钟收款金额超过历史5分钟平均水平3倍")
# ---------------------------------------------------------------------------

# --- fixed values: how long state of a key is kept after its last write (ids: after the first sight), in microseconds ---
HOUR_US = 3_600_000_000
DEDUP_TTL_US = 24 * HOUR_US
FAILURE_TTL_US = 6 * HOUR_US
USER_MEAN_TTL_US = 30 * 24 * HOUR_US
MERCHANT_MEAN_TTL_US = 14 * 24 * HOUR_US
# --------------------------------------------------------------------------------------------------------------------------

RULE_IDS = [r.rule_id for r in (R001, R002, R003, R004, R005, R006, R007, R008)]


@dataclass(frozen=True)
class RuleConfig:
    """Thresholds of the eight rules; the defaults are the production ones."""

    user_txn_count: int = 10
    user_amount: Decimal = Decimal("20000.00")
    device_users: int = 5
    card_users: int = 3
    consecutive_failures: int = 5
    user_spike_min_samples: int = 5
    user_spike_multiplier: Decimal = Decimal("5.0")
    merchant_spike_min_windows: int = 3
    merchant_spike_multiplier: Decimal = Decimal("3.0")
    version: int = 0

    def with_thresholds(self, thresholds: dict[str, float], version: int) -> "RuleConfig":
        """Override the main threshold of each rule named in ``thresholds``."""
        names = {
            "R001": ("user_txn_count", int), "R002": ("user_amount", _money),
            "R003": ("device_users", int), "R004": ("card_users", int),
            "R005": ("consecutive_failures", int), "R007": ("user_spike_multiplier", _ratio),
            "R008": ("merchant_spike_multiplier", _ratio),
            "R007.min_samples": ("user_spike_min_samples", int),
            "R008.min_windows": ("merchant_spike_min_windows", int),
        }
        changed = {}
        for rule_id, value in thresholds.items():
            # R006 asks for a flag and has no threshold
            if rule_id in names and value is not None:
                name, kind = names[rule_id]
                changed[name] = kind(value)
        return replace(self, version=version, **changed)


def _money(value) -> Decimal:
    return Decimal(str(value)).quantize(Decimal("0.01"))


def _ratio(value) -> Decimal:
    return Decimal(str(value)).quantize(Decimal("0.1"))


@dataclass(frozen=True)
class StreamConfig:
    """Options of the streaming job.

    Outputs and checkpoints are folders that the driver and all executors reach,
    so none of them has a default.
    """

    metric_output: str
    alert_output: str
    late_output: str
    dead_letter_output: str
    checkpoint_dir: str
    bootstrap_servers: str = "localhost:9092"
    transaction_topic: str = "payment_transaction_events"
    starting_offsets: str = "latest"
    watermark_seconds: int = 60
    trigger_seconds: int = 10
    max_offsets_per_trigger: int = 5_000_000
    max_files_per_trigger: int = 1000
    #: Into how many partitions a query divides its state; it stays so for its checkpoint.
    #: 0: the session's shuffle partitions.  A partition costs files in every
    #: micro-batch, however few its rows.
    state_partitions: int = 0
    #: Parquet tables that are read anew for every micro-batch: thresholds
    #: (version, rule_id, threshold) and black devices (device_id).
    rule_table: str = ""
    device_list: str = ""
    #: With a cool-down, alerts not too near to another of their rule and key
    #: also go to this folder (by default beside the alerts).
    cooldown_minutes: int = 0
    cooled_output: str = ""
    #: A parquet table of additions to and removals from the lists (``operators.lists``), read like the two above.
    list_changes: str = ""
    #: How many cities of each window to keep, and whether to count alerts as features of users.
    city_topn: int = 0
    user_features: bool = False
    #: When ``RiskStream.roll`` makes larger files of an output: at this size, at this
    #: age of its oldest batch, or when nothing came for so long; and how long rolled
    #: batches stay for streams that read them.
    roll_bytes: int = 64 << 20
    roll_seconds: int = 120
    idle_seconds: int = 30
    keep_seconds: int = 86_400
    rules: RuleConfig = field(default_factory=RuleConfig)


def stream_config(root: str, **options) -> StreamConfig:
    """All folders of the job below one root."""
    return StreamConfig(
        metric_output=f"{root}/metrics", alert_output=f"{root}/alerts", late_output=f"{root}/late",
        dead_letter_output=f"{root}/dead", checkpoint_dir=f"{root}/checkpoint", **options,
    )
