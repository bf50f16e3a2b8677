"""Sequential folds over ordered rows per key, streamed and restartable at range borders.

For the few operators whose next step depends on a state no aggregate can summarise.
Rows are shuffled by key (and by range for hot keys, see `ordered.cut`), sorted, and pass
through a Python step as Arrow batches; a task holds the state of one key, not its rows.
A hot key is folded range by range in parallel. Where the step has a `Summary`, that takes three
passes whatever the number of ranges: each range is summarised, the summaries of a key are
applied one after another to give the state each range starts from, and the ranges are folded.
Without one, ranges exchange their final states until these stop changing, which takes two
rounds when ranges contain a reset and never more rounds than ranges. The result is that of
the plain sequential fold.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from faultline.lineage import cut_lineage
from faultline.operators.ordered import CHUNK, HOT, HOT_ROWS, apply_cuts, find_cuts

Step = Callable[[object, list[dict]], tuple[object, list[dict]]]
STATE, FINAL = "_state", "_final"
OUT_BATCH = 4096


@dataclass(frozen=True)
class Summary:
    """What a range of rows does to any state, in a form that rows can be added to.

    `apply(state, s)` must be the state that the step reaches over the rows `add` put into `s`,
    for every state. Summaries and states must survive JSON.
    """

    empty: object
    add: Callable[[object, list[dict]], object]
    apply: Callable[[object, object], object]


def _dump(state) -> str:
    return json.dumps(state, sort_keys=True, default=str)


def _streamer(keys: Sequence[str], order: str, step: Step, empty, schema: pa.Schema, emit: bool):
    group = [*keys, CHUNK]

    def rows_of(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            yield from batch.to_pylist()

    def results(batches):
        for _, rows in groupby(rows_of(batches), key=lambda r: tuple(r[k] for k in group)):
            state, last = json.loads(_dump(empty)), None
            for _, same in groupby(rows, key=lambda r: r[order]):
                batch = list(same)
                last = batch[-1]
                for given in (r[STATE] for r in batch if r[STATE] is not None):
                    state = json.loads(given)
                real = [r for r in batch if r[STATE] is None]
                if real:
                    state, out = step(state, real)
                    if emit:
                        for o in out:
                            yield {**{k: real[0][k] for k in keys}, **o}
            if last is not None and last[HOT]:
                yield {**{k: last[k] for k in group}, FINAL: _dump(state)}

    return lambda batches: _batched(results(batches), schema)


def _batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    buffer = []
    for row in rows:
        buffer.append(row)
        if len(buffer) >= OUT_BATCH:
            yield pa.RecordBatch.from_pylist(buffer, schema=schema)
            buffer = []
    if buffer:
        yield pa.RecordBatch.from_pylist(buffer, schema=schema)


def _starts(summaries: DataFrame, keys: Sequence[str], initial: DataFrame | None, empty, apply: Callable) -> DataFrame:
    """State before each range: (keys, chunk, `_state`) from (keys, chunk, `_final`) with a range's summary."""
    schema = StructType([*[StructField(k, summaries.schema[k].dataType) for k in keys],
                         StructField(CHUNK, summaries.schema[CHUNK].dataType), StructField(STATE, StringType())])
    given = summaries.withColumn(STATE, F.lit(None).cast("string")) if initial is None else summaries.join(initial, list(keys), "left")
    arrow = to_arrow_schema(schema)

    def results(batches):
        rows = (r for batch in batches for r in batch.to_pylist())
        for _, ranges in groupby(rows, key=lambda r: tuple(r[k] for k in keys)):
            state = None
            for r in ranges:
                if state is None:
                    state = json.loads(r[STATE] if r[STATE] is not None else _dump(empty))
                yield {**{k: r[k] for k in keys}, CHUNK: r[CHUNK], STATE: _dump(state)}
                state = apply(state, json.loads(r[FINAL]))

    placed = given.repartition(*keys).sortWithinPartitions(*keys, CHUNK)
    return placed.mapInArrow(lambda batches: _batched(results(batches), arrow), schema)


def ordered_fold(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], step: Step, empty, out: StructType,
    initial: DataFrame | None = None, hot_rows: int | None = HOT_ROWS, cuts: DataFrame | None = None,
    summary: Summary | None = None,
) -> DataFrame:
    """Run `step(state, rows)` over the rows of each key in order; rows tied on order[0] go together.

    States must survive JSON. `initial` holds (keys, `_state`) rows for keys that do not start
    from `empty`. `cuts` are borders already found for these keys and this order. With a `summary`
    hot keys take three passes. Rows whose order[0] is null have no place and are left out.
    Output columns: keys and `out`.
    """
    keyed = rows.filter(F.col(order[0]).isNotNull())
    if cuts is None:
        cuts = find_cuts(keyed, keys, order[0], hot_rows)
    tagged = apply_cuts(keyed, keys, order[0], cuts).withColumn(STATE, F.lit(None).cast("string"))
    key_fields = [rows.schema[k] for k in keys]
    full = StructType([
        *[StructField(f.name, f.dataType, True) for f in key_fields], *out.fields,
        StructField(CHUNK, tagged.schema[CHUNK].dataType), StructField(FINAL, StringType()),
    ])

    def start_rows(states: DataFrame) -> DataFrame:
        """State rows sort before every ordinary row of their range."""
        present = set(states.columns)
        flags = {HOT: F.lit(True).cast(BooleanType()), CHUNK: F.lit(0)}
        return states.select(*[
            F.col(c) if c in present else flags.get(c, F.lit(None)).cast(tagged.schema[c].dataType).alias(c)
            for c in tagged.columns
        ])

    def run(data: DataFrame, emit: bool, step: Step = step, empty=empty) -> DataFrame:
        placed = data.repartition(*keys, CHUNK).sortWithinPartitions(
            *keys, CHUNK, F.col(order[0]).asc_nulls_first(), *order[1:])
        fn = _streamer(keys, order[0], step, empty, to_arrow_schema(full), emit)
        return placed.mapInArrow(fn, full)

    begin = tagged if initial is None else tagged.unionByName(
        start_rows(initial.withColumn(HOT, F.lit(False))))
    if cuts is not None and summary is not None:
        made = run(tagged.filter(HOT), False, lambda s, batch: (summary.add(s, batch), []), summary.empty).select(*keys, CHUNK, FINAL)
        begin = begin.unionByName(start_rows(cut_lineage(_starts(made, keys, initial, empty, summary.apply))))
    elif cuts is not None:
        hot = tagged.filter(HOT)
        if initial is not None:
            hot_keys = hot.select(*keys).distinct()
            hot = hot.unionByName(start_rows(initial.join(hot_keys, list(keys), "left_semi")))
        incoming, known = None, None
        while True:
            data = hot if incoming is None else hot.unionByName(start_rows(incoming))
            finals = run(data, emit=False).select(*keys, CHUNK, FINAL)
            finals = finals.withColumn(STATE, F.lag(FINAL).over(W.partitionBy(*keys).orderBy(CHUNK)))
            nxt = cut_lineage(finals.filter(F.col(STATE).isNotNull()).select(*keys, CHUNK, STATE))
            mark = nxt.agg(F.bit_xor(F.xxhash64(*keys, CHUNK, STATE)), F.count(F.lit(1))).first()
            incoming = nxt
            if mark == known:
                break
            known = mark
        begin = begin.unionByName(start_rows(incoming))
    return run(begin, emit=True).filter(F.col(FINAL).isNull()).drop(CHUNK, FINAL)
