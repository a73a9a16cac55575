"""What bare references mean, over micro-batches: a case's last case, act and rules are kept in a state store.

Cases are kept in BUCKETS groups by the hash of their ids, so that the calls of the state store are bounded: a micro-batch reads and writes the states
of the groups that its cases fall in, once each, and a task holds the paragraphs of one group. Paragraphs go to their group as they are, and their references
are found there, in one walk by case. Checkpoints of earlier versions can't be gone on with.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from casemill.operators import citations

PROVIDER, ROCKSDB = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "cases array<long>, last_case array<string>, last_act array<string>, last_rules array<string>"
BUCKETS = 1 << 10
PARAGRAPHS = "case_id long, id long, ordinal int, content string"
NUMBERS = ("case_id", "id", "ordinal")


class CaseState(StatefulProcessor):
    """Finds the references of a bucket's cases, and fills in the bare ones, paragraph by paragraph, from where the micro-batch before left off."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.said, self.shapes = handle.getValueState("said", STATE), citations.Shapes()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = self.said.get()
        states = {case: citations.Said(*said) for case, *said in zip(*kept, strict=True)} if kept else {}
        number = lambda x: None if x is None else int(x)
        # Paragraphs of the bucket in this micro-batch only; a null comes before all numbers.
        given = [(*map(number, numbers), t, al) for some in rows for *numbers, t, al in zip(*(some[c] for c in (*NUMBERS, "content", "aliases")), strict=True)]
        given.sort(key=lambda p: [(x is not None, x) for x in (p[0], p[2], p[1])])
        out = citations.Spans()
        for case, group in groupby(given, key=lambda p: p[0]):
            some = list(group)
            known = {k: (v["expanded"], v["kind"]) for k, v in json.loads(some[0][4] or "{}").items()}
            read = [(i, o, t, self.shapes.key(t)) for _, i, o, t, _ in some]
            for _ in citations.told(case, read, known, states.setdefault(case, citations.Said()), self.shapes, out):
                if out.size >= citations.BATCH:
                    yield _frame(out.taken())
        if out.size:
            yield _frame(out)
        self.said.update((list(states), *([getattr(s, c) for s in states.values()] for c in ("case", "act", "rules"))))

    def close(self) -> None:
        pass


def _frame(spans: citations.Spans) -> pd.DataFrame:
    """As a DataFrame on Arrow's arrays; lists as they are, which pandas would make again."""
    column = lambda values, kind: pd.Series(values, dtype=object) if pa.types.is_list(kind) else pd.Series(pd.arrays.ArrowExtensionArray(pa.array(values, kind)))
    return pd.DataFrame({f.name: column(values, f.type) for f, values in zip(citations.SPANS, spans.columns, strict=False)})


def in_context(paragraphs: DataFrame, aliases: DataFrame) -> DataFrame:
    """The references of a stream of paragraphs, as citations.extract_spans() gives them. The state store must be RocksDB's."""
    names = F.to_json(F.map_from_entries(F.collect_list(F.struct("short_name", F.struct("expanded", "kind")))))
    known = aliases.groupBy(F.col("case_id").alias("a_case")).agg(names.alias("aliases"))
    joined = paragraphs.filter("content IS NOT NULL").join(known, F.col("case_id") == F.col("a_case"), "left")
    # Numbers travel as text: pandas would make floats of long numbers beside nulls.
    texts = joined.select(F.pmod(F.xxhash64("case_id"), F.lit(BUCKETS)).alias("bucket"), *(F.col(c).cast("string").alias(c) for c in NUMBERS), "content", "aliases")
    return texts.groupBy("bucket").transformWithStateInPandas(CaseState(), citations.SPAN_SCHEMA, "Append", "None")


def stream_spans(spark: SparkSession, source: str, aliases: str, target: str, checkpoint: str) -> None:
    """Appends to target the references of the paragraphs in source's new files, by availableNow.

    source, aliases and target are folders of Parquet files (PARAGRAPHS; the rows of citations.extract_aliases). A case's paragraphs must come in order
    of their ordinals, in whatever files: one that comes late is read with the state as it is then. The checkpoint keeps the files read and each case's
    state, so that a run after a stop goes on where the last whole micro-batch ended. The state is three short texts a case.
    """
    session = spark.newSession()
    session.conf.set(PROVIDER, ROCKSDB)
    paragraphs = session.readStream.schema(PARAGRAPHS).parquet(source)
    known = session.read.schema("case_id long, short_name string, expanded string, kind string").parquet(aliases)
    filled = in_context(paragraphs, known)
    filled.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
