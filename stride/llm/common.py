"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stride.session import materialize

#: Texts are handed to per-batch functions in pieces of at most this many characters (one text is never cut).
PIECE_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write once below ``spark.checkpoint.dir`` and read back: cuts lineage, survives lost executors."""
    return materialize(df, f"llm-{name}")


def held_out(doc_id: Column | str, modulus: int, remainder: int) -> Column:
    """crc32 of the id's decimal text, modulo; false for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def no_doc_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def pieces(lengths: list[int], most: int = PIECE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of consecutive texts whose lengths sum to at most ``most`` (or one text alone)."""
    a, total = 0, 0
    for i, n in enumerate(lengths):
        if i > a and total + n > most:
            yield a, i
            a, total = i, 0
        total += n
    if a < len(lengths):
        yield a, len(lengths)


def map_texts(df: DataFrame, fn: Callable[[list, list], dict], schema: str, *cols: str, most: int = PIECE_CHARS,
              after: Callable[[], None] | None = None) -> DataFrame:
    """mapInArrow with bounded pieces: ``fn(columns)`` gets one list per column and returns a dict of output columns.

    ``after`` runs at the end of every task that came to its end.
    """
    from pyspark.sql.types import StructType

    arrow = _arrow_schema(StructType.fromDDL(schema))
    names = list(cols)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            length = pc.binary_length if pa.types.is_binary(columns[-1].type) or pa.types.is_large_binary(columns[-1].type) else pc.utf8_length
            lengths = pc.fill_null(length(columns[-1]), 0).to_pylist()
            for a, b in pieces(lengths, most):
                out = fn(*[c.slice(a, b - a).to_pylist() for c in columns])
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)
        if after:
            after()

    return df.select(*names).mapInArrow(run, schema)


def filter_texts(df: DataFrame, keep: Callable[[list], list], col: str, most: int = PIECE_CHARS) -> DataFrame:
    """The rows, all columns as they are, where ``keep(texts)`` is true of a column's text; record batches pass through whole."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(col)).cast(pa.string())
            kept = []
            for a, b in pieces(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), most):
                kept += keep(texts.slice(a, b - a).to_pylist())
            yield batch.filter(pa.array(kept, type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


def _arrow_schema(schema):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
