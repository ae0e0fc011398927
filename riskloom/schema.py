"""Column contract shared by every operator.

Operators never hard-code a column name: they take a ``TxnColumns``. ``DEFAULT`` is
the snake-case layout used in this repository; ``CARD_PAYMENTS`` is the layout of the
public card-payment data set, so its CSV files run unchanged.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# The key that stands for a missing entity, and the split names in time order.
MISSING_KEY = "__MISSING__"
SPLITS = ("train", "validation", "holdout")


@dataclass(frozen=True)
class TxnColumns:
    id: str = "transaction_id"
    time: str = "transaction_dt"
    amount: str = "transaction_amt"
    label: str = "is_fraud"
    history_keys: tuple[str, ...] = ("card1", "addr1", "p_emaildomain")
    frequency_keys: tuple[str, ...] = ("card1", "addr1", "p_emaildomain", "device_info")
    online_keys: tuple[str, ...] = ("card1", "addr1")
    device_type: str = "device_type"
    device_info: str = "device_info"
    identity_prefix: str = "id_"
    os_source: str = "id_30"
    browser_source: str = "id_31"
    # Further identifiers that never become model inputs.
    other_identifiers: tuple[str, ...] = ()
    reference_time: str = "2017-11-30"
    #: Types of columns that are read without being named above, by patterns of their names.
    pass_through: Mapping[str, T.DataType] = field(default_factory=dict, hash=False)

    @property
    def non_features(self) -> tuple[str, ...]:
        """Identifiers, raw time and label."""
        known = (self.id, self.time, self.label, *self.history_keys, *self.frequency_keys, self.device_type)
        return tuple(dict.fromkeys((*known, self.device_info, *self.other_identifiers)))

    @property
    def required(self) -> tuple[str, ...]:
        return (self.id, self.time, self.amount)

    @property
    def required_with_label(self) -> tuple[str, ...]:
        return (*self.required, self.label)


DEFAULT = TxnColumns()

CARD_PAYMENTS = TxnColumns(
    id="TransactionID",
    time="TransactionDT",
    amount="TransactionAmt",
    label="isFraud",
    history_keys=("card1", "addr1", "P_emaildomain"),
    frequency_keys=("card1", "addr1", "P_emaildomain", "DeviceInfo"),
    device_type="DeviceType",
    device_info="DeviceInfo",
    # The other identifying columns of that data set.
    pass_through={r"[CDV][0-9]+|dist[0-9]+|id_(0[0-9]|1[01])": T.DoubleType()},
    other_identifiers=("card2", "card3", "card4", "card5", "card6", "addr2", "R_emaildomain"),
)


def transaction_schema(cols: TxnColumns = DEFAULT, extra: T.StructType | None = None) -> T.StructType:
    """Explicit read schema of a transaction file; ``extra`` appends pass-through columns."""
    base = T.StructType(
        [
            T.StructField(cols.id, T.LongType()),
            T.StructField(cols.time, T.LongType()),
            T.StructField(cols.amount, T.DoubleType()),
            T.StructField(cols.label, T.IntegerType()),
            *[T.StructField(k, T.StringType()) for k in cols.history_keys],
        ]
    )
    return T.StructType(base.fields + (extra.fields if extra else []))


def identity_schema(cols: TxnColumns = DEFAULT, extra: T.StructType | None = None) -> T.StructType:
    """Explicit read schema of a device-identity file."""
    base = T.StructType(
        [
            T.StructField(cols.id, T.LongType()),
            T.StructField(cols.device_type, T.StringType()),
            T.StructField(cols.device_info, T.StringType()),
            T.StructField(f"{cols.identity_prefix}01", T.DoubleType()),
            T.StructField(cols.os_source, T.StringType()),
            T.StructField(cols.browser_source, T.StringType()),
        ]
    )
    return T.StructType(base.fields + (extra.fields if extra else []))
