"""Named tables over the log: `seqlog` takes and gives inserts, `seqlog-upsert` keyed changes."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from seqlog.functions.codec import body_text, decode_text, encode_json, json_decode
from seqlog.functions.records import no_headers
from seqlog.operators.changelog import assert_insert_only, split_key_value, upsert_decode, upsert_encode
from seqlog.operators.numbering import ordered
from seqlog.sinks.append import last_changes
from seqlog.sources.basin import fold_due
from seqlog.sources.datasource import read_stream, register
from seqlog.sources.options import SourceOptions
from seqlog.sources.scan import scan

APPEND = "seqlog"
UPSERT = "seqlog-upsert"
FORMATS = ("json", "text", "raw")
KIND = "_kind"


@dataclass(frozen=True)
class LogTable:
    """Schema, connector, format and options of one table.

    `options` are those of the source; `stream` is where inserts go. An upsert table needs `keys`;
    on a plain table they have no effect.
    """

    schema: T.StructType
    connector: str = APPEND
    format: str = "json"
    options: dict[str, str] = field(default_factory=dict)
    stream: str | None = None
    keys: tuple[str, ...] = ()

    def __post_init__(self):
        if self.connector not in (APPEND, UPSERT):
            raise ValueError(f"connector must be {APPEND} or {UPSERT}, not {self.connector!r}")
        if self.format not in FORMATS:
            raise ValueError(f"format must be one of {FORMATS}, not {self.format!r}")
        if self.connector == UPSERT:
            if self.format != "json":
                raise ValueError("an upsert table is stored as json")
            split_key_value(self.schema.names, list(self.keys))
        elif self.format != "json" and len(self.schema) != 1:
            raise ValueError(f"a {self.format} table has exactly one column")

    def source(self) -> SourceOptions:
        given = dict(self.options)
        names = {k.lower() for k in given}
        if self.stream and not names & {"streams", "discoveryprefix"}:
            given["streams"] = self.stream
        return SourceOptions.parse(given)

    def decode(self, log: DataFrame) -> DataFrame:
        """Declared columns; an upsert table adds the change kind as `_kind`."""
        if self.connector == UPSERT:
            return upsert_decode(log, self.schema, list(self.keys))
        name = self.schema.names[0]
        if self.format == "text":
            return decode_text(log, name)
        if self.format == "raw":
            return log.select(F.col("body").alias(name))
        return json_decode(log.select("body"), self.schema, on_error="fail")

    def read(self, spark: SparkSession) -> DataFrame:
        return self.decode(scan(spark, self.source()))

    def read_stream(self, spark: SparkSession) -> DataFrame:
        return self.decode(read_stream(spark, self.source()))

    def encode(self, df: DataFrame, order_by: list = ()) -> DataFrame:
        """`df`, its columns matched to the declared ones by name, as records: what the source's format writes.

        Batch frames come in the order of `order_by`; changes are reduced to the last one per key.
        """
        names = [f"_by{i}" for i in range(len(order_by))]
        order = [(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(order_by, names)]
        if self.connector == UPSERT:
            typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
            rows = df.select(*typed, KIND, *order) if KIND in df.columns else df.select(*typed, *order)
            if df.isStreaming:
                return upsert_encode(rows, list(self.keys), self.schema.names, KIND)
            records = last_changes(rows, list(self.keys), self.schema.names, KIND, names)
            names = ["_place"]
        else:
            if KIND in df.columns:
                df = assert_insert_only(df, KIND)
            typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
            rows = df.select(*typed, *order)
            if self.format == "json":
                records = encode_json(rows, self.schema.names, keep=names)
            else:
                body = F.col(self.schema.names[0]).cast("binary").alias("body")
                records = rows.select(*names, no_headers().alias("headers"), body)
        if names and not df.isStreaming:
            records = ordered(records, [], names)
        return records.select("headers", "body")

    def write(self, df: DataFrame, order_by: list = ()) -> None:
        """Append the rows of `df` through `format("seqlog")`."""
        basin = self._sink()
        register(df.sparkSession)
        writer = self.encode(df, order_by).write.format("seqlog").mode("append")
        writer.option("basin", basin).option("stream", self.stream).save()
        fold_due(df.sparkSession, basin)

    def write_stream(self, df: DataFrame, writer: str) -> DataStreamWriter:
        """A streaming insert, to be started; each micro-batch is an append. `writer` names the checkpoint's appends.

        Changes are all appended, as a stream of records has no last one per key.
        """
        basin = self._sink()
        register(df.sparkSession)
        sink = self.encode(df).writeStream.format("seqlog").option("basin", basin).option("stream", self.stream)
        return sink.option("writer", writer)

    def _sink(self) -> str:
        if not self.stream:
            raise ValueError("writing needs a stream")
        return self.source().basin


class Tables:
    """Tables by name, each also a temporary view for spark.sql."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: dict[str, LogTable] = {}

    def create(self, name: str, table: LogTable, streaming: bool = False) -> LogTable:
        self.tables[name] = table
        if streaming:
            table.read_stream(self.spark).createOrReplaceTempView(name)
        else:
            self.refresh(name)
        return table

    def refresh(self, name: str) -> None:
        """Point the view at the tails of now."""
        self.tables[name].read(self.spark).createOrReplaceTempView(name)

    def insert_into(self, name: str, query: str | DataFrame, order_by: list = ()) -> None:
        """INSERT INTO: append the rows of a query or frame to the table's stream."""
        rows = self.spark.sql(query) if isinstance(query, str) else query
        self.tables[name].write(rows, order_by)
        self.refresh(name)


def raw_text_view(log: DataFrame, name: str) -> None:
    """View of (stream, seq_num, text) over a log frame."""
    log.select("stream", "seq_num", body_text().alias("text")).createOrReplaceTempView(name)
