"""Table functions for SQL text, over Arrow batches: SELECT * FROM name(TABLE(...)).

Spark joins no Arrow table function laterally, so that each takes a table: a key and a text for functions of a text, and cases' paragraphs for their references:
by PARTITION BY case_id ORDER BY ordinal, or with many cases in each part, PARTITION BY pmod(xxhash64(case_id), 4096) ORDER BY (case_id, ordinal), as
Spark takes some tenths of a millisecond for each part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf

from casemill.operators import citations, html

TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}


def _of_text(function: Callable[[str | None], list[tuple]], columns: str):
    """A function of each row's text (second column); its key (first column, a long) goes along."""
    schema = pa.schema([("key", pa.int64()), *((c.split()[0], TYPES[c.split()[1]]) for c in columns.split(", "))])

    class OfText:
        def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
            found = [(k, *r) for k, t in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True) for r in function(t)]
            yield pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found, strict=True) if found else [[]] * len(schema), schema, strict=True)], schema=schema)

    return arrow_udtf(OfText, returnType=f"key long, {columns}")


def _tree(text: str | None) -> list[tuple]:
    return [tuple(r.get(c.split()[0]) for c in html.TREE.split(", ")) for r in html.provision_rows(text)]


class _Cases:
    """The references of each case, once all of its paragraphs (case_id, id, ordinal, content) are there. It holds one case, and a batch of rows."""

    shapes = citations.Shapes()

    def __init__(self):
        self.held: list[tuple] = []

    def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
        new = list(zip(*(rows.column(c).to_pylist() for c in ("case_id", "id", "ordinal", "content")), strict=True))
        begin = len(new)  # of the last case, which may go on
        while begin and new[begin - 1][0] == new[-1][0]:
            begin -= 1
        if begin or self.held and self.held[-1][0] != new[0][0]:
            yield from self._read(self.held + new[:begin])
            self.held = []
        self.held += new[begin:]

    def terminate(self) -> Iterator[pa.Table]:
        yield from self._read(self.held)

    def _read(self, rows: list[tuple]) -> Iterator[pa.Table]:
        for found in citations.walked(iter(rows), self.shapes):
            yield pa.Table.from_batches([found.batch()])


def register(spark: SparkSession) -> None:
    """Registers html_paragraphs, provision_tree, statute_definitions and alias_defs (of a key and a text), and citation_spans (of cases)."""
    found = {
        "html_paragraphs": _of_text(html.paragraph_rows, "pos int, text string, classes string, lines string"), "provision_tree": _of_text(_tree, html.TREE), "statute_definitions": _of_text(html.definition_rows, "term string, definition string"),
        "alias_defs": _of_text(lambda t: citations.alias_definitions(t or ""), "short_name string, expanded string, kind string, place int"), "citation_spans": arrow_udtf(_Cases, returnType=citations.SPAN_SCHEMA),
    }
    for name, function in found.items():
        spark.udtf.register(name, function)
