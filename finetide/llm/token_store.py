"""Token ids of documents in ORC files.

The table is range-sorted by id and encoded in the sorted tasks, so each file holds an id range
and the files' names are in id order. Ids are integer lists, which ORC stores by run-length
encoding in stripes that tasks read in parallel; row indexes and a Bloom filter on the document
id let a look-up skip stripes and row groups by their metadata. Each row also keeps the number
of ids its task wrote before it; a task's own start is the sum of the tasks before it.
"""

from __future__ import annotations

import json
import os
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finetide.llm.store import Stored
from finetide.llm.textcodes import hand_back, span_hashes, text_parts

END_ID = 2
#: Words that a worker remembers, words encoded at once, and bytes of text taken together.
REMEMBERED = 800_000
LEARNED = 1000
PART_BYTES = 2 << 20
#: Marks that a unit may end with.
MARKS = ".,;:!?#$%&*|"
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
}


#: White space other than the space and the line end, as it starts in UTF-8: single bytes, and pairs
#: of bytes of which not all are white space, so that some texts are encoded whole without need.
_OTHER_BLANKS = np.zeros(256, dtype=bool)
_OTHER_BLANKS[[9, 11, 12, 13, 28, 29, 30, 31]] = True
_BLANK_PAIRS = np.array([0xC285, 0xC2A0, 0xE19A, 0xE280, 0xE281, 0xE380])
_BLANK_LEADS = np.zeros(256, dtype=bool)
_BLANK_LEADS[_BLANK_PAIRS >> 8] = True
#: Third bytes after E2 80 that make white space.
_BLANK_THIRDS = np.zeros(256, dtype=bool)
_BLANK_THIRDS[[*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF]] = True


def cuts_at_blanks(tokenizer) -> bool:
    """Whether a tokenizer cuts texts before a space and around a line end, whatever is beside."""
    settings = json.loads(tokenizer.to_str())
    cutter = settings.get("pre_tokenizer") or {}
    whole = settings.get("normalizer") or settings.get("truncation") or settings.get("padding")
    plain = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
    tokens = settings.get("added_tokens") or []
    odd = any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or any(c.isspace() for c in t["content"]) for t in tokens)
    return bool(plain and not whole and not odd)


def plain_texts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which texts have single spaces and line ends between words for all their white space."""
    n = len(data)
    bad = np.zeros(n + 1, np.int64)
    if n:
        blank = (data == 32) | (data == 10)
        odd = _OTHER_BLANKS[data]
        at = np.flatnonzero(_BLANK_LEADS[data[:-1]])
        at = at[np.isin(data[at].astype(np.int64) * 256 + data[at + 1], _BLANK_PAIRS)]
        third = data[np.minimum(at + 2, n - 1)]
        odd[at] |= (data[at] != 0xE2) | (data[at + 1] != 0x80) | _BLANK_THIRDS[third]
        odd[:-1] |= blank[:-1] & blank[1:]
        edges = np.concatenate([off[:-1], off[1:] - 1])
        edges = edges[(edges >= 0) & (edges < n)]
        odd[edges] |= blank[edges]
        np.cumsum(odd, out=bad[1:])
    return (bad[off[1:]] == bad[off[:-1]]) & (off[1:] > off[:-1])


def gathered(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """pool[start : start + size] of each span, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(pool)) < 1 << 31 else np.int64
    places = np.repeat((starts - (ends - sizes)).astype(kind), sizes)
    places += np.arange(total, dtype=kind)
    return pool[places]


def byte_letters() -> np.ndarray:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others in order from U+0100 on."""
    own = np.zeros(256, dtype=bool)
    for low, high in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)):  # fixed values: the ranges taken as printable
        own[low : high + 1] = True
    table = np.arange(256, dtype="<u4")
    table[~own] = 256 + np.arange(int((~own).sum()))
    return table


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings, and offsets into them."""
    _, places, values = column.buffers()
    off = np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8), off


class Memory:
    """Words and their ids in runs sorted by hash, some 45 bytes a word; a found word is compared byte by byte.

    Two runs of about one size become one. What comes when ``most`` words are held is not kept.
    """

    def __init__(self, most: int) -> None:
        self.most = most
        self.runs: list[tuple[np.ndarray, ...]] = []  # keys, word sizes, word bytes, numbers of ids, ids

    def __len__(self) -> int:
        return sum(len(run[0]) for run in self.runs)

    def find(self, keys: np.ndarray, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(which words, numbers of ids, ids) per run of the words data[off[i] : off[i + 1]]."""
        left = np.arange(len(keys))
        for own_keys, sizes, words, counts, ids in self.runs:
            at = np.minimum(np.searchsorted(own_keys, keys[left]), len(own_keys) - 1)
            which = np.flatnonzero((own_keys[at] == keys[left]) & (sizes[at] == off[left + 1] - off[left]))
            at, found = at[which], left[which]
            length = sizes[at].astype(np.int64)
            same = gathered(words, _starts(sizes)[at], length) == gathered(data, off[found], length)
            if not same.all():  # another word of the same hash
                good = np.add.reduceat(np.append(same, False), np.cumsum(length) - length) == length
                at, found, which = at[good], found[good], which[good]
            yield found, counts[at], gathered(ids, _starts(counts)[at], counts[at].astype(np.int64))
            left = np.delete(left, which)

    def add(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        if not len(keys) or len(self) >= self.most:
            return
        run = (keys, (ends - starts).astype(np.int32), gathered(data, starts, ends - starts), counts.astype(np.int32), ids)
        self.runs.append(_sorted(run))
        while len(self.runs) > 1 and 2 * len(self.runs[-1][0]) >= len(self.runs[-2][0]):
            other, run = self.runs.pop(), self.runs.pop()
            self.runs.append(_sorted(tuple(np.concatenate(both) for both in zip(run, other, strict=True))))


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes, dtype=np.int64) - sizes


def _sorted(run: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    keys, sizes, words, counts, ids = run
    order = np.argsort(keys, kind="stable")
    words = gathered(words, _starts(sizes)[order], sizes[order].astype(np.int64))
    return keys[order], sizes[order], words, counts[order], gathered(ids, _starts(counts)[order], counts[order].astype(np.int64))


class Encoder:
    """A tokenizer that remembers words.

    Where the pre-tokenizer cuts before a space and around a line end that stand alone, and these are
    all the white space of a text, its ids are those of its units: a word with the space before it,
    or one with the line end before it. Byte-level pre-tokenizers also cut between a letter and the
    marks behind it, so a unit is a core and its marks. Arrow splits the texts and numbers the
    different cores of a part, Python looks each of them up once, and numpy puts the ids together.
    New cores are encoded many at once; those of letters alone are one piece for the pre-tokenizer and
    go to a copy of the tokenizer that cuts at line ends only. Cores that a part has more than once are
    remembered, until ``remembered`` of them are; rarer ones would only fill the memory.

    Texts with other white space, and all texts of other tokenizers, are encoded whole.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; more threads only contend
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.line_end = self.ids("\n")
        self.by_unit = cuts_at_blanks(self.tokenizer) and len(self.line_end) == 4
        self.line_id = int(np.frombuffer(self.line_end, dtype="<u4")[0]) if self.by_unit else -1
        self.known = Memory(remembered)
        if self.by_unit:
            self.letters = byte_letters()
            settings = json.loads(self.tokenizer.to_str())
            line = {"type": "Split", "pattern": {"String": chr(self.letters[10])}, "behavior": "Isolated", "invert": False}
            self.bare = Tokenizer.from_str(json.dumps({**settings, "pre_tokenizer": line, "added_tokens": []}))

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()

    def _new(self, words: list[str], letters_only: bool, lined: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each word, all ids) of words after a space, or after a line end, whose id they include.
        A line end between two words is a token of its own and occurs nowhere else."""
        sizes, found = [np.zeros(0, np.int64)], [np.zeros(0, "<u4")]
        for i in range(0, len(words), LEARNED):
            joined = "\n" + "\n".join(words[i : i + LEARNED]) if lined else " " + "\n ".join(words[i : i + LEARNED])
            tokenizer = self.tokenizer
            if letters_only:
                tokenizer = self.bare
                joined = self.letters[np.frombuffer(joined.encode(), np.uint8)].tobytes().decode("utf-32-le")
            ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            line = ids == self.line_id
            cuts = np.flatnonzero(line)
            sizes.append(np.diff(np.append(cuts, len(ids))) if lined else np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1)
            found.append(ids if lined else ids[~line])
        return np.concatenate(sizes), np.concatenate(found)

    def _cores(self, cores: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, sizes, ids) of different cores; a core starts with a line end, or stands for one
        after a space."""
        data, off = string_bytes(cores)
        keys = span_hashes(data, off[:-1], off[1:])
        sizes = np.zeros(len(keys), np.int64)
        unknown = np.ones(len(keys), bool)
        order, parts = [], []
        for at, own, ids in self.known.find(keys, data, off):
            unknown[at], sizes[at] = False, own
            order.append(at)
            parts.append(ids)
        fresh, place = cores.filter(pa.array(unknown)), np.flatnonzero(unknown)
        names = fresh.to_pylist()
        after_line = pc.starts_with(fresh, "\n").to_numpy(zero_copy_only=False)
        letters = pc.utf8_is_alpha(pc.utf8_ltrim(fresh, "\n")).to_numpy(zero_copy_only=False)
        some = off[place + 1] > off[place]  # before a text's first line end is nothing
        for lined in (False, True):
            for bare in (True, False):
                own = np.flatnonzero((after_line == lined) & (letters == bare) & some)
                at = place[own]
                sizes[at], ids = self._new([names[k][lined:] for k in own.tolist()], bare, lined)
                self.known.add(keys[at], data, off[at], off[at + 1], sizes[at], ids)
                order.append(at)
                parts.append(ids)
        ids, place = np.concatenate(parts), np.concatenate(order)
        starts = np.zeros(len(keys), np.int64)
        starts[place] = np.cumsum(sizes[place]) - sizes[place]
        return starts, sizes, ids

    def _by_unit(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each text, all ids) of plain texts."""
        # A line end is put before each text, whose id is left out at the end.
        marked = pc.replace_substring(pc.binary_join_element_wise("\n", texts, ""), "\n", " \n")
        lists = pc.split_pattern(marked, " ")
        units = lists.flatten().dictionary_encode()
        codes, different = units.indices.to_numpy(zero_copy_only=False), units.dictionary
        cut = pc.utf8_rtrim(different, MARKS)
        length = pc.binary_length(different).to_numpy(zero_copy_only=False).astype(np.int64)
        size = pc.binary_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
        ends_in_letter = pc.utf8_is_alpha(pc.utf8_slice_codeunits(cut, -1)).to_numpy(zero_copy_only=False)
        has_marks = ends_in_letter & (size < length) & (length - size <= 8)
        cores = pc.if_else(pa.array(has_marks), cut, different).dictionary_encode()
        of = cores.indices.to_numpy(zero_copy_only=False)
        starts, sizes, ids = self._cores(cores.dictionary)
        tail_of, tails = self._tails(different, np.where(has_marks, size, length))
        tail_sizes = np.array([len(t) // 4 for t in tails], np.int64)
        pool = np.concatenate([ids, np.frombuffer(b"".join(tails), "<u4")])
        both = np.stack([of, len(sizes) + tail_of], axis=1).ravel()
        starts = np.concatenate([starts, len(ids) + np.cumsum(tail_sizes) - tail_sizes])
        sizes = np.concatenate([sizes, tail_sizes])
        # The ids of each different unit, its core's and its marks', and from them those of the texts.
        unit_ids, unit_sizes = gathered(pool, starts[both], sizes[both]), sizes[both].reshape(-1, 2).sum(axis=1)
        ids = gathered(unit_ids, (np.cumsum(unit_sizes) - unit_sizes)[codes], unit_sizes[codes])
        before = np.concatenate([[0], np.cumsum(unit_sizes[codes])])
        off = lists.offsets.to_numpy(zero_copy_only=False) - lists.offsets[0].as_py()
        keep = np.ones(len(ids), bool)
        keep[before[off[:-1]]] = False
        return np.diff(before[off]) - 1, ids[keep]

    def _tails(self, units: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """For each unit which of the different marks follow the first ``sizes`` bytes, and their ids."""
        data, off = string_bytes(units)
        packed, at = np.zeros(len(units), np.uint64), off[:-1] + sizes
        for _ in range(8):  # marks are ASCII, eight at most
            more = at < off[1:]
            packed[more] = packed[more] << np.uint64(8) | data[at[more]]
            at = at + more
        different, number = np.unique(packed, return_inverse=True)
        marks = [int(p).to_bytes(8, "big").lstrip(b"\0").decode() for p in different]
        return number, [self.ids(m) if m else b"" for m in marks]

    def encode(self, texts: pa.Array, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids of each text, all ids), of some neighbouring texts at a time, with ``end_id`` after each text."""
        for i, j, data, off in text_parts(texts, PART_BYTES):
            part = texts.slice(i, j - i)
            plain = plain_texts(data, off) if self.by_unit else np.zeros(j - i, bool)
            odd = np.flatnonzero(~plain & (off[1:] > off[:-1]))
            sizes = np.zeros(j - i, np.int64)
            ids, whole = np.zeros(0, "<u4"), []
            if plain.any():
                sizes[plain], ids = self._by_unit(part.filter(pa.array(plain)))
            if len(odd):
                whole = [np.frombuffer(self.ids(t), "<u4") for t in part.take(pa.array(odd)).to_pylist()]
                sizes[odd] = [len(w) for w in whole]
            starts = np.concatenate([[0], np.cumsum(sizes + 1)])
            out = np.full(starts[-1], end_id, dtype="<u4")
            places = starts[:-1][plain]
            out[gathered(np.arange(len(out)), places, sizes[plain])] = ids
            for k, w in zip(odd.tolist(), whole, strict=True):
                out[starts[k] : starts[k] + len(w)] = w
            yield sizes + 1, out
            hand_back()  # what this part's strings took


def encoder_of(path: str, remembered: int) -> Encoder:
    """The worker process's encoder, which lives on from task to task where Spark reuses workers.

    Functions reach workers by value with globals of their own, so it is kept in a module made for it.
    """
    kept = sys.modules.setdefault("_finetide_kept", types.ModuleType("_finetide_kept")).__dict__.setdefault("encoders", {})
    if (path, remembered) not in kept:
        kept[path, remembered] = Encoder(path, remembered)
    return kept[path, remembered]


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED) -> None:
    """Encodes the whole texts of ``docs``, appends ``end_id`` to each, and writes ORC files under ``path``.

    Rows are in ascending id order, null first, rows of one id by a hash of their text, so that rows
    of one id may lie in several files. A null text reads as empty and has the end id alone. An empty
    table writes no row. A worker remembers about ``remembered`` words, at some 45 bytes each.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("mark", F.xxhash64("text"))
    order = ["doc_id", "mark", "text"]
    ordered = kept.repartitionByRange("doc_id", "mark").sortWithinPartitions(*order).drop("mark")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = encoder_of(tokenizer_path, remembered), 0
        for batch in batches:
            row = 0
            for sizes, ids in encoder.encode(batch.column(1), end_id):
                off = np.concatenate([[0], np.cumsum(sizes)])
                tokens = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids.view("<i4")))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(sizes)), pa.array(before + off[:-1]), tokens], names=["doc_id", "before", "tokens"])
                row += len(sizes)
                before += int(off[-1])

    kind = kept.schema["doc_id"].dataType.simpleString()
    ordered.mapInArrow(run, f"doc_id {kind}, before bigint, tokens array<int>").write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, before, tokens) as written; filters on ``doc_id`` skip stripes and row groups."""
    return spark.read.orc(path)


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per row, from the files under ``path``.

    Ids are counted through each writing task, whose number is in its files' names, so it does not
    matter into how many files a task's rows were cut.
    """
    task = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("bigint").alias("task")
    stored = read_tokens(spark, path).select("doc_id", "before", "tokens", task)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column(2)
            off = tokens.offsets.to_numpy(zero_copy_only=False)
            raw = memoryview(np.ascontiguousarray(tokens.values.to_numpy(zero_copy_only=False), dtype="<i4").view(np.uint8))
            crc = np.fromiter((zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(off, off[1:], strict=False)), dtype=np.int64, count=len(off) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(np.diff(off).astype(np.int64)), pa.array(crc)],
                names=["doc_id", "before", "task", "n_tokens", "ids_crc32"],
            )

    kind = stored.schema["doc_id"].dataType.simpleString()
    rows = Stored(stored.mapInArrow(run, f"doc_id {kind}, before bigint, task bigint, n_tokens bigint, ids_crc32 bigint"), "digests").df
    tasks = rows.groupBy("task").agg(F.max(F.col("before") + F.col("n_tokens")).alias("n"))  # a row per task
    ahead = F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    starts = tasks.select("task", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    return rows.join(starts, "task").select("doc_id", (F.col("ahead") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
