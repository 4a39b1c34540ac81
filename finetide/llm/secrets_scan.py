"""Secrets in texts: trigram postings, Boolean trigram queries, and a check of the candidates.

Each rule's pattern yields a query: a conjunction of alternatives, each a set of trigrams that
any match must hold. Texts are indexed in segments, one part of a task's input each: the
postings list, for each trigram that some query names, the texts that hold it. A query is
answered by intersecting and uniting postings; only its candidates are searched with the
pattern. A pattern from which no trigram follows has no query and searches every text. Letters
are folded in the index alone, so candidates are never fewer than the texts that match.

The index lives as long as its segment: a scan reads every text once and moves none, so there
is nothing to shuffle, whatever the number of secrets or the size of one source.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

try:
    from re import _parser as sre_parse
except ImportError:  # Python 3.10 and older
    import sre_parse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finetide.llm.textcodes import lowered, text_parts

#: Most literal alternatives followed inside one pattern before its run is cut.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A secret's kind, its pattern, and the least length of ``group`` that counts."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


# The base kinds in their order.
BASE_RULES = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        6,
        2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),  # a run of 24 or more is its own leftmost match
)

# Public token formats beyond the base kinds.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def trigram_query(pattern: str) -> list[list[frozenset[bytes]]]:
    """Clauses that a matching text meets: in each, all trigrams of one alternative occur.

    Trigrams are of folded ASCII bytes. An empty list means that nothing can be required.
    """
    clauses: list[list[frozenset[bytes]]] = []

    def close(strings: set[str]) -> None:
        grams = [frozenset(s[i : i + 3].encode() for i in range(len(s) - 2)) for s in strings]
        if all(grams):
            clauses.append(grams)

    def walk(parsed) -> None:
        run = {""}
        for item in parsed:
            strings = _strings([item])
            joined = None if strings is None else {a + b for a, b in product(run, strings)}
            if joined is not None and len(joined) <= MOST_STRINGS:
                run = joined
                continue
            close(run)
            run = strings if strings is not None else {""}
            op, value = str(item[0]), item[1]
            if strings is None and op == "SUBPATTERN":
                walk(value[3])
            elif strings is None and op in ("MAX_REPEAT", "MIN_REPEAT") and value[0] >= 1:
                walk(value[2])
        close(run)

    walk(sre_parse.parse(pattern))
    return clauses


def _strings(parsed) -> set[str] | None:
    """All folded strings that a piece can match, or None where they are many or unknown."""
    out = {""}
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            own = {chr(value).lower()} if value < 128 else None
        elif name == "IN" and all(str(k) == "LITERAL" and v < 128 for k, v in value):
            own = {chr(v).lower() for _, v in value}
        elif name == "SUBPATTERN":
            own = _strings(value[3])
        elif name == "BRANCH":
            parts = [_strings(p) for p in value[1]]
            own = None if any(p is None for p in parts) else set().union(*parts)
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[1] != sre_parse.MAXREPEAT and value[1] <= 2:
            base = _strings(value[2])
            own = None if base is None else {"".join(p) for n in range(value[0], value[1] + 1) for p in product(base, repeat=n)}
        else:
            own = None
        if own is None or len(out) * len(own) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in own}
    return out


class Postings:
    """Per trigram of ``wanted`` the texts of one segment that hold it, in order."""

    def __init__(self, wanted: list[bytes], data: np.ndarray, off: np.ndarray) -> None:
        self.size = len(off) - 1
        self.lists: dict[bytes, np.ndarray] = {}
        if len(data) < 3 or not wanted:
            return
        codes = np.array([g[0] << 16 | g[1] << 8 | g[2] for g in wanted])
        number = np.full(1 << 24, -1, dtype=np.int32) if not hasattr(Postings, "_table") else Postings._table
        number[codes] = np.arange(len(codes))
        Postings._table = number
        low = lowered(data).astype(np.int32)
        found = number[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
        number[codes] = -1
        at = np.flatnonzero(found >= 0)
        text = np.searchsorted(off, at, side="right") - 1
        inside = at + 3 <= off[text + 1]
        pairs = np.unique(found[at[inside]].astype(np.int64) * self.size + text[inside])
        which, text = pairs // self.size, pairs % self.size
        edges = np.searchsorted(which, np.arange(len(wanted) + 1))
        for k, gram in enumerate(wanted):
            self.lists[gram] = text[edges[k] : edges[k + 1]]

    def answer(self, clauses: list[list[frozenset[bytes]]]) -> np.ndarray:
        """The texts that meet every clause; all of them when there is none."""
        result = np.arange(self.size)
        none = np.zeros(0, np.int64)
        for clause in clauses:
            either = none
            for grams in clause:
                hit = result
                for gram in grams:
                    hit = np.intersect1d(hit, self.lists.get(gram, none), assume_unique=True)
                either = np.union1d(either, hit)
            result = either
        return result


def scan(
    docs: DataFrame,
    rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, found: array of (kind, start, end, value)) per row of ``docs``, in the order found.

    Spans are leftmost and do not overlap within a kind; places count code points, the end
    excluded. They are ordered by start, then by the order of ``rules``. Null and empty texts
    find nothing; repeated rows and null ids keep a row each; an empty table gives an empty one.
    """
    compiled = [(r, re.compile(r.pattern, re.ASCII), trigram_query(r.pattern)) for r in rules]
    wanted = sorted({g for _, _, clauses in compiled for clause in clauses for grams in clause for g in grams})
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found_type = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
    )
    numbers = [r.kind for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i, _, data, off in text_parts(batch.column(1)):
                postings = Postings(wanted, data, off)
                texts: dict[int, str] = {}
                for rule, pattern, clauses in compiled:
                    for k in postings.answer(clauses).tolist():
                        if k not in texts:
                            texts[k] = data[off[k] : off[k + 1]].tobytes().decode()
                        for m in pattern.finditer(texts[k]):
                            if len(m[rule.group]) >= rule.least:
                                span = {"kind": rule.kind, "start": m.start(), "end": m.end(), "value": m[0]}
                                out[i + k].append(span)
            for spans in out:
                spans.sort(key=lambda s: (s["start"], numbers.index(s["kind"])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, type=found_type)], names=["id", "found"])

    kind = kept.schema["id"].dataType.simpleString()
    schema = f"id {kind}, found array<struct<kind string, start bigint, end bigint, value string>>"
    return kept.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def spans_text(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    each = F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def of_kinds(found: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(found, lambda s: s["kind"].isin(*kinds))
