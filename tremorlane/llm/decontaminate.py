"""Benchmark decontamination with an Aho-Corasick automaton over normalised items."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlane.llm.common import filter_texts, slices, staged, utf8

WINDOW = 10
ANCHOR = 5  # words by which a window is found
#: Windows of so many bytes go into one automaton, with their ids.
PATTERN_BYTES = 64 << 20
_CUTS = bytes(i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 else 0x20 for i in range(256))
_MOST = 1 << 14  # windows of an item made at a time
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

Runs = list[tuple[int, int]]


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of digits, letters and anything beyond ASCII."""
    return text.lower().translate(_CUTS).split()


def windows(text: bytes, length: int = WINDOW) -> Iterator[set[bytes]]:
    """The windows of an item, `_MOST` at a time, as words with one space between."""
    words = words_of(text)
    count = max(1, len(words) - length + 1) if words else 0
    for first in range(0, count, _MOST):
        some = range(first, min(first + _MOST, count))
        yield {b" ".join(words[i : i + length]) for i in some}


def anchor(words: list[bytes]) -> int:
    """Where the `ANCHOR` words of a window begin that stand for it: those of least hash.

    Windows that overlap mostly have one anchor, so there are far fewer
    anchors than windows.
    """
    spots = range(max(1, len(words) - ANCHOR + 1))
    return min(spots, key=lambda i: xxhash.xxh3_64_intdigest(b" ".join(words[i : i + ANCHOR])))


class Matcher:
    """One automaton for all windows of a block.

    It works on words, each a number, and holds the anchors of the windows.
    Where an anchor occurs, the windows that have theirs there are looked up
    in full, at most one for each place that the anchor has in them.
    """

    def __init__(self, block: Iterable[tuple[str | None, bytes]]):
        self.owners: dict[bytes, tuple[str | None, ...]] = {}
        self.numbers: dict[bytes, int] = {}
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        places: dict[tuple[int, ...], set[tuple[int, int]]] = defaultdict(set)
        for item_id, window in block:
            known = self.owners.get(window)
            self.owners[window] = (item_id,) if known is None else (*known, item_id)
            if known is None:
                words = window.split()
                at = anchor(words)
                key = tuple(
                    self.numbers.setdefault(word, len(self.numbers) + 1)
                    for word in words[at : at + ANCHOR]
                )
                places[key].add((at, len(words)))
        for key, spots in places.items():
            self.machine.add_word(key, (len(key), tuple(spots)))
        self.machine.make_automaton()

    def hits(self, words: list[bytes]) -> tuple[Runs, set[str | None]]:
        """Runs (first, end) of words inside an occurring window, and the items that occur."""
        runs, items = [], set()
        if self.numbers and words:
            find = self.numbers.get
            numbers = tuple([find(word, 0) for word in words])
            for last, (size, spots) in self.machine.iter(numbers):
                for at, count in spots:
                    first = last - size + 1 - at
                    if first < 0 or first + count > len(words):
                        continue
                    ids = self.owners.get(b" ".join(words[first : first + count]))
                    if ids is not None:
                        runs.append((first, first + count))
                        items.update(ids)
        return joined(runs), items


@lru_cache(maxsize=1)
def matcher(block: Broadcast) -> Matcher:
    """The windows of a block, from the Arrow table that was broadcast."""
    found = pa.ipc.open_stream(block.value).read_all()
    columns = (found.column(name) for name in ("item_id", "window"))
    return Matcher((i.as_py(), w.as_py()) for i, w in zip(*columns, strict=True))


def joined(runs: Runs) -> Runs:
    """Sorted runs without overlaps; those that touch become one."""
    out: Runs = []
    for first, end in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def byte_spans(text: bytes, runs: Runs) -> list[dict[str, int]]:
    """Runs of words as byte offsets in the original text."""
    if not runs:
        return []
    spans = [match.span() for match in _WORD.finditer(text.lower())]
    return [{"start": spans[first][0], "end": spans[end - 1][1]} for first, end in runs]


_PAIRS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_STATE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text", pa.binary()),
        ("runs", _PAIRS),
        ("items", pa.list_(pa.string())),
    ]
)
_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("spans", _PAIRS),
    ]
)
_PAIRS_DDL = "array<struct<start: long, end: long>>"
_STATE_DDL = f"doc_id long, text binary, runs {_PAIRS_DDL}, items array<string>"
_RESULT_DDL = f"doc_id long, n_words long, n_hit long, items array<string>, spans {_PAIRS_DDL}"


def _scan(state: DataFrame, block: Broadcast, last: bool) -> DataFrame:
    def row(doc_id, text, runs, items):
        words = words_of(text)
        new, ids = matcher(block).hits(words)
        runs = joined([*((run["start"], run["end"]) for run in runs), *new])
        items = sorted({*items, *ids} - {None})
        if not last:
            runs = [{"start": first, "end": end} for first, end in runs]
            return {"doc_id": doc_id, "text": text, "runs": runs, "items": items}
        return {
            "doc_id": doc_id,
            "n_words": len(words),
            "n_hit": sum(end - first for first, end in runs),
            "items": items,
            "spans": byte_spans(text, runs),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _RESULT if last else _STATE
        for batch in slices(batches, "text"):
            columns = (batch.column(name).to_pylist() for name in _STATE.names)
            yield pa.RecordBatch.from_pylist([row(*x) for x in zip(*columns, strict=True)], schema)

    return state.mapInArrow(run, _RESULT_DDL if last else _STATE_DDL)


def _exploded(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, window): the different windows of the different items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            items = zip(*(batch.column(c).to_pylist() for c in ("item_id", "text")), strict=True)
            for item_id, text in items:
                for some in windows(text, window):
                    ids = pa.array([item_id] * len(some), pa.string())
                    found = pa.array(some, pa.binary())
                    yield pa.RecordBatch.from_arrays([ids, found], ["item_id", "window"])

    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), utf8("text").alias("text")
    )
    return items.distinct().mapInArrow(run, "item_id string, window binary").distinct()


def _blocks(benchmark: DataFrame, window: int, most: int) -> Iterator[Callable[[], Broadcast]]:
    """The windows in parts of some `most` bytes, ids included, each brought over when called.

    They are dealt by window and id, so neither repeated or long items nor a
    window of many items make a part larger.
    """
    context = benchmark.sparkSession.sparkContext
    found = staged(_exploded(benchmark, window), "windows")
    bytes_of = F.octet_length("window") + F.coalesce(F.octet_length("item_id"), F.lit(0))
    size = found.agg(F.sum(bytes_of)).first()[0] or 0
    count = 1 if size <= most else -(-2 * size // most)
    dealt = found.withColumn("block", F.expr(f"pmod(xxhash64(item_id, window), {count})"))
    for number in range(count):
        part = dealt.where(F.col("block") == number).select("item_id", "window")

        def collect(part=part):
            rows, sink = part.toArrow(), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as out:
                out.write_table(rows)
            return context.broadcast(sink.getvalue().to_pybytes())

        yield collect


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = PATTERN_BYTES
) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) for every row of `docs`.

    A window is `window` consecutive words of an item; an item of fewer words
    is one window. A word of a document inside any occurrence of a window is
    hit; `items` are the ids, as sorted texts, of the items with a window in
    it, and `spans` the hit stretches as byte offsets in the original UTF-8.
    Null and empty texts have no words. An item without words has no windows;
    one without an id hits words and is not listed. Repeated rows are returned
    as often as they come. An empty table of documents gives no rows, an empty
    benchmark no hits. Only ids and texts are read.

    The items are cut into their different windows in Spark and these are
    measured first. Up to `most` bytes of them are one automaton, which every task builds from a broadcast, and the
    texts are scanned once. Beyond that they are dealt into blocks of that size,
    which are collected, broadcast and scanned for one after the other.
    """
    blocks = list(_blocks(benchmark, window, most))
    state = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        utf8("text").alias("text"),
        F.expr(f"cast(array() as {_PAIRS_DDL})").alias("runs"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    for block in blocks:
        state = _scan(state, block(), last=block is blocks[-1])
        if block is not blocks[-1]:
            state = staged(state, "scanned")
    return state


def contamination_digest(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`contamination` with a digest of the ids in place of items and spans."""
    return contamination(docs, benchmark, window).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = PATTERN_BYTES
) -> DataFrame:
    """The rows of `docs` without a hit word, in the sense of `contamination`; all columns stay."""
    kept = docs
    for number, block in enumerate(_blocks(benchmark, window, most)):
        shared = block()

        def clean(texts: list[bytes], shared=shared) -> list[bool]:
            found = matcher(shared).hits
            return [not found(words_of(text))[0] for text in texts]

        kept = filter_texts(staged(kept, "clean") if number else kept, clean)
    return kept
