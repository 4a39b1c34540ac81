"""Row maps and filters, and building rows from columns or records."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    VariantType,
    _parse_datatype_string,
)

from finetide.errors import DataError
from finetide.functions.memory import hand_back

#: Text that is turned into pandas objects at once.
PART_BYTES = 2 * 1024 * 1024
ARROW_TYPES = {
    StringType: pa.string(), BinaryType: pa.binary(), BooleanType: pa.bool_(), ByteType: pa.int8(), ShortType: pa.int16(), IntegerType: pa.int32(),
    LongType: pa.int64(), FloatType: pa.float32(), DoubleType: pa.float64(), DateType: pa.date32(),
}
#: Columns whose values need neither a time zone nor their inner types to become pandas objects.
PLAIN = (*ARROW_TYPES, DecimalType)
DTYPES = {BooleanType: "bool", ByteType: "int8", ShortType: "int16", IntegerType: "int32", LongType: "int64", FloatType: "float32", DoubleType: "float64"}


def map_columns(df: DataFrame, columns: Mapping[str, Column], remove: Sequence[str] = ()) -> DataFrame:
    """Add or replace columns, then drop those in ``remove`` that were not replaced."""
    return df.withColumns(dict(columns)).drop(*[c for c in remove if c not in columns])


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Map by a user's function over batches of rows, for what no Column can express.

    Rows of plain columns become pandas objects ``PART_BYTES`` at a time, so batches of long texts come
    to the function in parts. With nested columns or instants a batch is an Arrow batch.
    """
    fields, read = StructType.fromDDL(schema).fields, df.schema.fields
    if not all(isinstance(f.dataType, PLAIN) for f in [*fields, *read]) or len({f.name for f in read}) < len(read):
        return df.mapInPandas(lambda batches: one_at_a_time(fn, batches), schema)
    types = {f.name: _arrow_type(f.dataType) for f in fields}
    kinds = [DTYPES.get(type(f.dataType)) for f in read]
    safe = df.sparkSession.conf.get("spark.sql.execution.pandas.convertToArrowArraySafely") == "true"

    def of_part(part: pa.RecordBatch) -> pa.RecordBatch:
        columns = {n: _series(c, kind) for n, c, kind in zip(part.schema.names, part.columns, kinds, strict=True)}
        return _to_arrow(fn(pd.DataFrame(columns, index=range(len(part)))), types, safe)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from one_at_a_time(of_part, _parts(batch))

    return df.mapInArrow(run, schema)


def _arrow_type(kind: DataType) -> pa.DataType:
    return pa.decimal128(kind.precision, kind.scale) if isinstance(kind, DecimalType) else ARROW_TYPES[type(kind)]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of ``PART_BYTES`` at most, or of one row."""
    n = len(batch)
    if n <= 1 or batch.nbytes <= PART_BYTES:
        yield batch
        return
    yield from _parts(batch.slice(0, n // 2))
    yield from _parts(batch.slice(n // 2))


def _series(column: pa.Array, kind: str | None) -> pd.Series:
    """As Spark hands a column to a pandas function: integers with nulls are floats, booleans with nulls objects."""
    found = column.to_pandas(date_as_object=True)
    if kind is None or (column.null_count and kind == "bool"):
        return found
    return found.astype("float64" if column.null_count and kind.startswith("int") else kind, copy=False)


def _to_arrow(found: pd.DataFrame, types: Mapping[str, pa.DataType], safe: bool) -> pa.RecordBatch:
    """A result's columns, matched as Spark does: by name where the function gave names, else by position."""
    if not isinstance(found, pd.DataFrame):
        raise DataError(f"the function gave a {type(found).__name__}, not a pandas DataFrame", "schema")
    if found.empty and not len(found.columns):
        return pa.RecordBatch.from_pydict({n: pa.array([], t) for n, t in types.items()})
    named = any(isinstance(n, str) for n in found.columns)
    if named and (odd := set(types) ^ set(found.columns[: len(types)])):
        raise DataError(f"the function's columns and the schema differ in {', '.join(sorted(map(str, odd)))}", "schema")
    if len(found.columns) < len(types):
        raise DataError(f"the function gave {len(found.columns)} columns for {len(types)}", "schema")
    columns = {}
    for i, (name, kind) in enumerate(types.items()):
        column = found[name] if named else found.iloc[:, i]
        if isinstance(column.dtype, pd.CategoricalDtype):
            column = column.astype(column.dtype.categories.dtype)
        mask = None if hasattr(column.array, "__arrow_array__") else column.isnull().to_numpy()
        columns[name] = pa.Array.from_pandas(column, mask=mask, type=kind, safe=safe)
    return pa.RecordBatch.from_pydict(columns)


def one_at_a_time(fn: Callable[[Any], Any], batches: Iterator[Any]) -> Iterator[Any]:
    """``fn`` of each batch. A batch and its result are let go, and their memory handed back, before
    the next is read, so a worker's memory is that of one batch however many it has seen."""
    for batch in batches:
        out = fn(batch)
        del batch
        yield out
        del out
        hand_back()


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str) -> DataFrame:
    """Map by a user's function over Arrow batches as they come: nested, decimal and binary columns
    pass through unchanged, and no column becomes a pandas object. Columns are matched by name."""
    names = [f.name for f in StructType.fromDDL(schema).fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if missing := set(names) - set(out.schema.names):
                raise DataError(f"the function gave no column {', '.join(sorted(missing))}", "schema")
            table = pa.Table.from_batches([out]) if isinstance(out, pa.RecordBatch) else out
            yield from table.select(names).to_batches()

    return df.mapInArrow(run, schema)


def filter_rows(df: DataFrame, predicate: Column | Callable[..., pd.Series], *inputs: str, arrow: bool = False) -> DataFrame:
    """Filter by a Column, or by a user's function of whole columns ``inputs``: pandas series, or
    with ``arrow`` Arrow arrays. A null answer drops the row."""
    if isinstance(predicate, Column):
        return df.filter(predicate)
    if not inputs:
        raise DataError("name the columns the predicate reads", "inputs")
    several = len(inputs) > 1
    if not arrow and all(isinstance(f.dataType, StringType) for f in df.select(*inputs).schema.fields):
        return df.filter(F.arrow_udf(_by_parts(predicate, several), "boolean", F.ArrowUDFType.SCALAR_ITER)(*inputs))

    def run(batches: Iterator[Any]) -> Iterator[Any]:
        return one_at_a_time(lambda batch: predicate(*batch) if several else predicate(batch), batches)

    udf = F.arrow_udf(run, "boolean", F.ArrowUDFType.SCALAR_ITER) if arrow else F.pandas_udf(run, "boolean", F.PandasUDFType.SCALAR_ITER)
    return df.filter(udf(*inputs))


def _by_parts(predicate: Callable[..., pd.Series], several: bool) -> Callable[[Iterator[Any]], Iterator[pa.Array]]:
    """The predicate over text columns that become pandas objects ``PART_BYTES`` at a time: whole
    batches of long texts would be in memory as Arrow and as objects."""

    def answers(columns: tuple[pa.Array, ...]) -> Iterator[pa.Array]:
        rows = len(columns[0])
        if rows > 1 and sum(c.nbytes for c in columns) > PART_BYTES:
            for start, n in ((0, rows // 2), (rows // 2, rows - rows // 2)):
                yield from answers(tuple(c.slice(start, n) for c in columns))
            return
        found = predicate(*[c.to_pandas() for c in columns])
        if len(found) != rows:
            raise DataError(f"the predicate gave {len(found)} answers for {rows} rows", "predicate")
        found = pd.Series(found)
        yield pa.Array.from_pandas(found, mask=found.isnull().to_numpy(), type=pa.bool_(), safe=False)

    def whole(batch: Any) -> pa.Array:
        return pa.concat_arrays(answers(batch if several else (batch,)))

    return lambda batches: one_at_a_time(whole, batches)


def from_columns(batches: DataFrame, columns: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows from column arrays. Each input row holds one batch: equally long arrays, one
    per result column. Unequal lengths fail the query. Adds ``position`` within the batch."""
    if not columns:
        raise DataError("no columns given", "columns")
    arrays = [F.col(source) for source in columns.values()]
    sizes = [F.size(a) for a in arrays]
    equal = reduce(lambda ok, s: ok & (s == sizes[0]), sizes, F.lit(True))
    checked = F.when(equal, F.arrays_zip(*[a.alias(n) for n, a in zip(columns, arrays)])).otherwise(
        F.raise_error(F.lit("columns differ in length"))
    )
    names = list(columns)
    rows = batches.select(*keep, F.posexplode(checked).alias("position", "_row"))
    return rows.select(*keep, "position", *[F.col("_row").getField(n).alias(n) for n in names])


def from_records(df: DataFrame, json_col: str, order_col: str) -> DataFrame:
    """Rows from JSON records with the first record's columns, in its order: keys that
    only later records have are dropped, and keys they lack become null.

    A column's type holds every record's values: numbers widen, and values of several kinds
    are kept as their JSON text. A malformed record fails the query.
    """
    by_order = df.select(order_col, json_col).orderBy(order_col)
    first = by_order.limit(1).select(json_col, F.json_object_keys(json_col).alias("keys")).head()
    if first is None:
        raise DataError("no records", "records")
    keys = first["keys"]
    whole = df.select(F.parse_json(json_col).alias("v")).agg(F.schema_of_variant_agg("v")).head()[0]
    found = _parse_datatype_string(whole.replace("OBJECT<", "STRUCT<"))
    kinds = {f.name: _plain(f.dataType) for f in found.fields} if isinstance(found, StructType) else {}
    schema = StructType([StructField(k, kinds.get(k, StringType())) for k in keys])
    parsed = df.select(order_col, F.from_json(json_col, schema, {"mode": "FAILFAST"}).alias("_record"))
    return parsed.select(*[F.col("_record").getField(k).alias(k) for k in keys])


def _plain(kind: DataType) -> DataType:
    """A type every value can be read in: text where the values are of several kinds."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _plain(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_plain(kind.elementType))
    if isinstance(kind, DecimalType):
        return kind if kind.scale == 0 else DoubleType()
    return StringType() if isinstance(kind, (NullType, VariantType)) else kind
