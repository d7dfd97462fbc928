r"""CSV export.

Each table becomes a directory of part files written in parallel (one per task),
every part with its own header when ``include_header`` is on.  The contract is
round-trip equality -- reading the export back with the table's schema gives the
same rows -- not byte equality with any single-file writer:

* quotes are doubled inside quoted fields (``escape='"'``);
* leading and trailing blanks are kept (Spark's CSV writer trims them by default);
* timestamps are written with microseconds, ``yyyy-MM-dd HH:mm:ss.SSSSSS``;
* each export chooses its own NULL text: an empty field where a row has several columns (an empty string is ``""``),
  ``\N`` where it has one, since readers skip empty lines, or ``\NN``, ``\NNN``, ... where a value is made of those signs;
* ``_schema.json`` beside the part files records columns, types and every option a reader needs.  It is written last,
  and readers of CSV folders pass over names that begin with ``_``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millstar.sinks.base import Sink
from millstar.sources import fs

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DATE_FORMAT = "yyyy-MM-dd"
SIDECAR = "_schema.json"
# Never the text of a field: the writer quotes control characters with the rest of a value.
_NO_TEXT = "\u0000\u0001null\u0001\u0000"


def null_text(df: DataFrame) -> str:
    """A NULL text that no value of ``df`` equals (one aggregate, for tables of one text column only)."""
    if len(df.columns) != 1:
        return ""
    kind, value = df.schema[0].dataType, F.col(f"`{df.columns[0]}`")
    if not isinstance(kind, T.StringType):
        return r"\N"
    longest = df.where(value.rlike(r"^\\N+$")).agg(F.max(F.length(value))).first()[0]
    return "\\" + "N" * (longest or 1)


def _common(options, spec: dict):
    return (options.option("sep", spec["delimiter"])
            .option("header", spec["header"])
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("timestampFormat", spec["timestamp_format"])
            .option("timestampNTZFormat", spec["timestamp_format"])
            .option("dateFormat", spec["date_format"]))


class CsvSink(Sink):
    def __init__(self, base_path: str, delimiter: str = ",", include_header: bool = True,
                 null: str | None = None, compression: str | None = None):
        """``null``: the NULL text; chosen by ``null_text`` where it is not given.  ``compression``: a codec of Spark's
        CSV writer (readers tell it by the file names), none by default."""
        self.base_path = base_path.rstrip("/")
        self.delimiter = delimiter
        self.include_header = include_header
        self.null = null
        self.compression = compression

    def write(self, df: DataFrame, name: str) -> str:
        path = f"{self.base_path}/{name}"
        spec = {"delimiter": self.delimiter, "header": self.include_header,
                "null": null_text(df) if self.null is None else self.null,
                "timestamp_format": TIMESTAMP_FORMAT, "date_format": DATE_FORMAT}
        # A lone column is quoted throughout: a value of blanks would be an empty line to readers.
        (_common(df.write.mode("overwrite"), spec).option("nullValue", spec["null"])
         .option("quoteAll", len(df.columns) == 1).option("compression", self.compression or "none").csv(path))
        fs.write_text(df.sparkSession, f"{path}/{SIDECAR}", json.dumps({**spec, "schema": df.schema.jsonValue()}))
        return path


def export_spec(spark: SparkSession, path: str) -> dict | None:
    """What the sidecar of an export records, or None."""
    text = fs.read_text(spark, f"{path.rstrip('/')}/{SIDECAR}")
    return json.loads(text) if text else None


def read_csv_export(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    delimiter: str | None = None, include_header: bool | None = None) -> DataFrame:
    """Read an export back (strings may hold newlines).

    Schema and options come from the sidecar; what is passed goes before it, and an export without one needs a schema.
    """
    spec = export_spec(spark, path) or {"delimiter": ",", "header": True, "null": "",
                                        "timestamp_format": TIMESTAMP_FORMAT, "date_format": DATE_FORMAT}
    if schema is None:
        if "schema" not in spec:
            raise ValueError(f"{path} has no {SIDECAR}: pass its schema")
        schema = T.StructType.fromJson(spec["schema"])
    spec = {**spec, **({} if delimiter is None else {"delimiter": delimiter}),
            **({} if include_header is None else {"header": include_header})}
    return (_common(spark.read.schema(schema), spec)
            .option("multiLine", True)
            .option("nullValue", spec["null"] or _NO_TEXT)
            .option("emptyValue", "")
            .option("mode", "FAILFAST")
            .csv(path))
