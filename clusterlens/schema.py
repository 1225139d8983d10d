"""Record layouts and the schemas of the tables the package exchanges."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class RecordLayout:
    """Positions inside one delimited record line.

    ``width`` counts every field including the label. ``categorical`` are
    the positions one-hot encoded by the mixed parser and dropped by the
    numeric parser. ``label_index`` ``-1`` means the last field.
    """

    width: int
    categorical: tuple[int, ...] = (1, 2, 3)
    label_index: int = -1
    sep: str = ","
    names: tuple[str, ...] = field(default=())

    @property
    def label_pos(self) -> int:
        return self.label_index % self.width

    @property
    def numeric(self) -> tuple[int, ...]:
        skip = set(self.categorical) | {self.label_pos}
        return tuple(i for i in range(self.width) if i not in skip)

    def name(self, i: int) -> str:
        return self.names[i] if self.names else f"f{i}"


# The connection-record layout of the reference's data set
# (41 features + label, protocol/service/flag categorical at 1, 2, 3).
CONNECTION_NAMES = (
    "duration", "protocol_type", "service", "flag", "src_bytes", "dst_bytes",
    "land", "wrong_fragment", "urgent", "hot", "num_failed_logins",
    "logged_in", "num_compromised", "root_shell", "su_attempted", "num_root",
    "num_file_creations", "num_shells", "num_access_files",
    "num_outbound_cmds", "is_host_login", "is_guest_login", "count",
    "srv_count", "serror_rate", "srv_serror_rate", "rerror_rate",
    "srv_rerror_rate", "same_srv_rate", "diff_srv_rate",
    "srv_diff_host_rate", "dst_host_count", "dst_host_srv_count",
    "dst_host_same_srv_rate", "dst_host_diff_srv_rate",
    "dst_host_same_src_port_rate", "dst_host_srv_diff_host_rate",
    "dst_host_serror_rate", "dst_host_srv_serror_rate",
    "dst_host_rerror_rate", "dst_host_srv_rerror_rate", "label",
)
CONNECTION_LAYOUT = RecordLayout(width=42, categorical=(1, 2, 3),
                                 names=CONNECTION_NAMES)


def connection_schema() -> T.StructType:
    """Typed schema for ``spark.read.schema(...).csv`` of connection records."""
    fields = []
    for i, name in enumerate(CONNECTION_NAMES):
        is_text = i in CONNECTION_LAYOUT.categorical or i == 41
        fields.append(T.StructField(
            name, T.StringType() if is_text else T.DoubleType(), True))
    return T.StructType(fields)


def layout_schema(layout: RecordLayout) -> T.StructType:
    """Typed CSV schema for any layout: numerics double, the rest string."""
    num = set(layout.numeric)
    return T.StructType([
        T.StructField(layout.name(i),
                      T.DoubleType() if i in num else T.StringType(), True)
        for i in range(layout.width)])


CENTERS_SCHEMA = T.StructType([
    T.StructField("cluster", T.IntegerType(), False),
    T.StructField("center", T.ArrayType(T.DoubleType(), False), False),
])

WEIGHTED_CENTERS_SCHEMA = T.StructType([
    T.StructField("cluster", T.IntegerType(), False),
    T.StructField("center", T.ArrayType(T.DoubleType(), False), False),
    T.StructField("weight", T.DoubleType(), False),
])

# report row as written for the dashboard (cluster, label, count)
REPORT_JSON_SCHEMA = T.StructType([
    T.StructField("cluster", T.IntegerType(), True),
    T.StructField("label", T.StringType(), True),
    T.StructField("count", T.LongType(), True),
])
