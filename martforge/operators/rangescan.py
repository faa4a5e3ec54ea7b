"""Running aggregates over ordered groups of any size, by ranges with carries.

A window ``PARTITION BY key ORDER BY o`` sends a whole group to one task. Here rows are sorted by
(key, order) in ranges, so a group lies in consecutive partitions, however large it is:

1. one range exchange and a sort inside the partitions;
2. one pass over each partition keeps running values per group, and at the end of a partition leaves a
   note with the values of the group that may go on in later ones;
3. one exchange by partition number takes rows and notes to the place where the group goes on, and the
   values of its notes are combined with those of its rows.

Two exchanges per scan, one lazy plan for all group sizes: nothing is counted beforehand, broadcast or
decided by size. A note goes to every later partition: partitions squared, halved, tiny rows.

Sums are exact: a decimal travels as the sums of its integer part and of its fraction in units of its
scale, both 64-bit integers. Passes run on Arrow batches; other columns are passed on untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, IntegralType, LongType, StructField, StructType

from martforge.session import ship_package

_ROW, _NOTE, _HASH, _ONES = 0, 1, "_key_hash", "_ones"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _starts(batch, keys: Sequence[str], last) -> np.ndarray:
    """Whether each row begins a group; ``last`` is the one-row batch before, or None. Nulls are equal."""
    import pyarrow as pa
    import pyarrow.compute as pc

    out = np.zeros(batch.num_rows, bool)
    out[0] = last is None
    for k in keys:
        now = batch.column(k)
        before = now.slice(0, len(now) - 1)
        if last is not None:
            before, now = pa.concat_arrays([last.column(k), before]), now
        else:
            now = now.slice(1)
        differs = pc.fill_null(pc.not_equal(now, before), False).to_numpy(zero_copy_only=False)
        differs |= now.is_null().to_numpy(zero_copy_only=False) != before.is_null().to_numpy(zero_copy_only=False)
        out[len(out) - len(differs):] |= differs
    return out


def _scan(df: DataFrame, keys: Sequence[str], order: Sequence[Column], read: Sequence[str], kept: Sequence[str],
          added: Sequence[StructField], new_pass: Callable) -> DataFrame:
    """Steps 1 and 2. The pass reads the keys, ``read`` and ``kept`` columns and hands on the keys and ``kept``.

    ``new_pass`` makes the state of a partition: ``rows(batch, starts)`` -> (numbers of the rows handed on or
    None for all, arrays of the added columns), ``note()`` -> values of the added columns, or None.
    """
    ship_package(df.sparkSession)
    df = df.withColumn(_HASH, F.xxhash64(*keys))  # sorts by one long what differs in its key
    keys = [_HASH, *keys]
    passed = list(dict.fromkeys([*keys, *kept]))
    schema = StructType([*[StructField(c, df.schema[c].dataType) for c in passed], *added, StructField("_dest", IntegerType()), StructField("_note", IntegerType())])
    n = _partitions(df)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        place, state, last = TaskContext.get().partitionId(), new_pass(), None
        types = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, columns = state.rows(batch, _starts(batch, keys, last))
            last = batch.slice(batch.num_rows - 1)
            types = [c.type for c in columns]
            own = [batch.column(c) if rows is None else batch.column(c).take(rows) for c in passed]
            size = len(own[0])
            yield pa.RecordBatch.from_arrays([*own, *columns, pa.array(np.full(size, place, np.int32)), pa.array(np.full(size, _ROW, np.int32))], schema.names)
        if last is None:
            return
        values, later = state.note(), n - 1 - place
        if values is None or later <= 0:
            return
        same = pa.array(np.zeros(later, np.int64))
        own = [last.column(c).take(same) if c in keys else pa.nulls(later, last.column(c).type) for c in passed]
        values = [v.take(same).cast(t) for v, t in zip(values, types, strict=True)]
        yield pa.RecordBatch.from_arrays([*own, *values, pa.array(np.arange(place + 1, n, dtype=np.int32)), pa.array(np.full(later, _NOTE, np.int32))], schema.names)

    ranged = df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    return ranged.select(*dict.fromkeys([*passed, *read])).mapInArrow(run, schema)


def _carried(scanned: DataFrame, keys: Sequence[str], folds: Mapping[str, Column]) -> DataFrame:
    """Step 3: rows with the folded values of the notes of their group, null where there are none."""
    here = Window.partitionBy(_HASH, "_dest", *keys)
    settled = scanned.repartitionById(_partitions(scanned), "_dest")
    return settled.withColumns({n: f.over(here) for n, f in folds.items()}).where(F.col("_note") == _ROW)


class _Sums:
    """Running sums of 64-bit columns within groups, and of ones."""

    def __init__(self, measures: Sequence[str]) -> None:
        self.measures, self.total = measures, dict.fromkeys(measures, 0)

    def rows(self, batch, starts: np.ndarray) -> tuple:
        import pyarrow as pa

        first = np.flatnonzero(starts)
        group = np.cumsum(starts)  # 0: goes on from the batch before
        out = []
        for m in self.measures:
            own = np.ones(batch.num_rows, np.int64) if m == _ONES else batch.column(m).to_numpy(zero_copy_only=False)
            run = np.cumsum(own)
            base = np.concatenate([[-self.total[m]], run[first] - own[first]])
            run = run - base[group]
            self.total[m] = int(run[-1])
            out.append(pa.array(run))
        return None, out

    def note(self) -> list:
        import pyarrow as pa

        return [pa.array([self.total[m]], pa.int64()) for m in self.measures]


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: Mapping[str, Column], rank: str | None = None,
                 kept: Sequence[str] | None = None) -> DataFrame:
    """Running sums of integer or decimal columns, and the row number, from the start of a group to each row.

    They are added to the ``kept`` columns (all by default). ``order`` must be total within a group. A sum is NULL as long as all values are NULL. Decimals of up to
    28 digits give decimals of ten digits more, integers give longs. NULL keys are values like others.
    """
    staged, parts, results = df, {}, {}
    for no, (name, e) in enumerate(sums.items()):
        kind = df.select(e.alias("e")).schema["e"].dataType
        if isinstance(kind, DecimalType) and kind.precision <= 28 and kind.scale <= 15:
            whole = F.floor(e)
            unit = Decimal(1).scaleb(-kind.scale)
            parts |= {f"_h{no}": whole.cast("long"), f"_l{no}": ((e - whole) * F.lit(Decimal(10) ** kind.scale)).cast("long")}
            total = lambda c, no=no, s=kind.scale, unit=unit: (
                c(f"_h{no}").cast(DecimalType(19 + s, s)) + c(f"_l{no}").cast(DecimalType(20, 0)) * F.lit(unit).cast(DecimalType(s + 1, s)))
            results[name] = (no, total, DecimalType(min(38, kind.precision + 10), kind.scale))
        elif isinstance(kind, IntegralType):
            parts[f"_h{no}"] = e.cast("long")
            results[name] = (no, lambda c, no=no: c(f"_h{no}"), LongType())
        else:
            raise TypeError(f"{name}: running sums need integers or decimals of up to 28 digits, not {kind.simpleString()}")
        parts[f"_c{no}"] = e.isNotNull().cast("long")
    staged = df.withColumns({n: F.coalesce(e, F.lit(0).cast("long")) for n, e in parts.items()})
    measures, kept = [*parts, *([_ONES] if rank else [])], list(df.columns if kept is None else kept)
    scanned = _scan(staged, keys, order, list(parts), kept, [StructField(f"_run{m}", LongType()) for m in measures], lambda: _Sums(measures))
    settled = _carried(scanned, keys, {f"_before{m}": F.sum(F.when(F.col("_note") == _NOTE, F.col(f"_run{m}"))) for m in measures})

    def whole_sum(m: str) -> Column:
        return F.col(f"_run{m}") + F.coalesce(f"_before{m}", F.lit(0))

    out = {n: F.when(whole_sum(f"_c{no}") > 0, total(whole_sum).cast(kind)) for n, (no, total, kind) in results.items()}
    if rank:
        out[rank] = whole_sum(_ONES).cast("int")
    return settled.select(*kept, *[c.alias(n) for n, c in out.items()])


class _Least:
    """The offered row of smallest place seen so far in the group; rows that ask are kept."""

    _NONE = 1 << 33  # above every place

    def __init__(self, place: str, offers: str, columns: Sequence[str]) -> None:
        self.place, self.offers, self.columns, self.best, self.at = place, offers, columns, None, self._NONE

    def rows(self, batch, starts: np.ndarray) -> tuple:
        import pyarrow as pa

        n = batch.num_rows
        group = np.cumsum(starts)
        offers = batch.column(self.offers).to_numpy(zero_copy_only=False).astype(bool)
        place = np.where(offers, batch.column(self.place).to_numpy(zero_copy_only=False).astype(np.int64), self._NONE)
        # Later groups lie lower, so one running minimum serves all; what was held counts for group 0.
        low = place - group * (2 * self._NONE)
        least = np.minimum.accumulate(np.concatenate([[self.at], low]))
        held = np.maximum.accumulate(np.where(np.concatenate([[self.at < self._NONE], offers & (low < least[:-1])]), np.arange(n + 1), -1))[1:]
        known = least[1:] + group * (2 * self._NONE) < self._NONE
        before = self.best if self.best is not None else pa.RecordBatch.from_arrays([pa.nulls(1, batch.column(c).type) for c in self.columns], list(self.columns))
        both = [pa.concat_arrays([before.column(c), batch.column(c)]) for c in self.columns]
        asks = np.flatnonzero(~offers)
        index = pa.array(np.where(known[asks], held[asks], 0), pa.int64(), mask=~known[asks])
        out = [c.take(index) for c in both]
        at = pa.array([int(held[-1])]) if known[-1] else None
        self.best = None if at is None else pa.RecordBatch.from_arrays([c.take(at) for c in both], list(self.columns))
        self.at = int(least[-1] + group[-1] * (2 * self._NONE)) if at is not None else self._NONE
        return pa.array(asks, pa.int64()), out

    def note(self) -> list | None:
        return None if self.best is None else self.best.columns


def earliest_offer(df: DataFrame, keys: Sequence[str], order: Sequence[Column], offers: str, place: str, columns: Sequence[str],
                   kept: Sequence[str], out: str) -> DataFrame:
    """The ``kept`` columns of the rows that do not offer (``offers`` is false), with ``out``: among the offering
    rows before them in their group the one of smallest ``place`` (an int, not null), as a struct of ``place``
    and ``columns``."""
    taken = [place, *columns]
    added = [StructField(f"_best_{c}", df.schema[c].dataType) for c in taken]
    scanned = _scan(df, keys, order, [offers, *taken], kept, added, lambda: _Least(place, offers, taken))
    own = F.when(F.col(f"_best_{place}").isNotNull(), F.struct(*[F.col(f"_best_{c}").alias(c) for c in taken]))
    settled = _carried(scanned.withColumn("_own", own), keys, {"_carry": F.min(F.when(F.col("_note") == _NOTE, F.col("_own")))})
    return settled.select(*kept, F.least("_own", "_carry").alias(out))
