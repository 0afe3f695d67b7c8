"""Repeated substrings, found by anchors and decided on suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlane.llm.common import slices, staged, utf8
from tremorlane.llm.suffix_array import suffix_array

LENGTH = 100  # bytes of a string that counts as repeated
GRAM = 32  # bytes of an anchor, a multiple of 8
PIECE_BYTES = 1 << 20  # a longer text is looked through in pieces that overlap
POOL_BYTES = 32 << 20  # equal contexts of so much text are brought together before the shuffle
BLOCK_BYTES = 256 << 10  # text of one suffix array
GROUP = 1_024  # contexts of an anchor that are decided in one block; more are dealt out

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_PLACE = np.uint64(24)


def _gram_hashes(text: bytes) -> np.ndarray:
    """A 64-bit mix of the GRAM bytes at each position."""
    count = len(text) - GRAM + 1
    view = np.ndarray(len(text) - 7, "<u8", text, strides=(1,))
    mixed = np.zeros(count, np.uint64)
    for i in range(0, GRAM, 8):
        mixed ^= view[i : i + count]
        mixed *= _M1
        mixed ^= mixed >> np.uint64(32)
    mixed *= _M2
    mixed ^= mixed >> np.uint64(29)
    return mixed


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row, by doubling."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    if size < width:
        values = np.minimum(values[: size - width], values[width - size :])
    return values


def contexts(pieces: list[bytes]) -> tuple[np.ndarray, ...]:
    """Contexts of all pieces: (piece, first window, windows, anchor's offset, key, digest).

    A window is LENGTH bytes of one piece. Its anchor is the position of the
    least hash of GRAM bytes in it, the first of equals, so equal windows have
    equal anchors at equal offsets. Windows in a row that share an anchor form
    a context; `key` is the hash at the anchor, `digest` one of all its bytes.
    """
    text = b"".join(pieces)
    sizes = np.array([len(piece) for piece in pieces], np.int64)
    ends = np.cumsum(sizes)
    if len(text) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashes = _gram_hashes(text)
    numbered = (hashes >> _PLACE << _PLACE) | np.arange(len(hashes), dtype=np.uint64)
    anchor = _window_least(numbered, LENGTH - GRAM + 1) & np.uint64((1 << 24) - 1)
    anchor = anchor.astype(np.int64)
    whole = np.ones(len(text), bool)
    over = (ends[:, None] - np.arange(1, LENGTH)).ravel()
    kept = (np.arange(1, LENGTH) <= sizes[:, None]).ravel()
    whole[over[kept]] = False
    whole = whole[: len(anchor)]
    change = np.ones(len(anchor), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])
    begin = ends - sizes
    change[begin[begin < len(change)]] = True
    first = np.flatnonzero(change)
    count = np.diff(np.r_[first, len(anchor)])
    first, count = first[whole[first]], count[whole[first]]
    digest = xxhash.xxh3_64_intdigest
    stops = (first + count + LENGTH - 1).tolist()
    digests = [digest(text[a:b]) for a, b in zip(first.tolist(), stops, strict=True)]
    piece = np.searchsorted(ends, first, "right")
    at = anchor[first]
    return (
        piece,
        first - begin[piece],
        count,
        at - first,
        hashes[at],
        np.array(digests, np.uint64),
    )


def _cut(text: bytes) -> list[tuple[int, bytes]]:
    """Pieces of a text with their positions; every window lies whole in exactly one."""
    if len(text) <= PIECE_BYTES + LENGTH - 1:
        return [(0, text)]
    starts = range(0, len(text) - LENGTH + 1, PIECE_BYTES)
    return [(at, text[at : at + PIECE_BYTES + LENGTH - 1]) for at in starts]


#: A context, or where `windows` is 0 a stretch of `size` bytes to be removed.
_FOUND = "key long, digest long, ord long, at long, windows int, anchor int, size long"
_SCHEMA = pa.schema(
    [
        ("key", pa.int64()),
        ("digest", pa.int64()),
        ("ord", pa.int64()),
        ("at", pa.int64()),
        ("windows", pa.int32()),
        ("anchor", pa.int32()),
        ("size", pa.int64()),
    ]
)


def _rows(key, digest, order, at, windows, anchor, size) -> pa.RecordBatch:
    columns = (key, digest, order, at, windows, anchor, size)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.ascontiguousarray(column).astype(field.type.to_pandas_dtype()))
            for column, field in zip(columns, _SCHEMA, strict=True)
        ],
        schema=_SCHEMA,
    )


def _stretches(order: np.ndarray, at: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Stretches to remove; those of one document that touch become one."""
    by = np.lexsort((end, at, order))
    order, at, end = order[by], at[by], end[by]
    if len(at):
        # The furthest end so far within a document, by shifting documents apart.
        apart = np.cumsum(np.r_[0, order[1:] != order[:-1]]) * (int(end.max()) + 1)
        reach = np.maximum.accumulate(end + apart)
        fresh = np.r_[True, at[1:] + apart[1:] > reach[:-1]]
        heads = np.flatnonzero(fresh)
        end = np.maximum.reduceat(end, heads)
        order, at = order[heads], at[heads]
    # Keyed by their place, to be dealt out evenly.
    key = (order.astype(np.uint64) * _M1 ^ at.astype(np.uint64)) * _M2
    none = np.zeros(len(at), np.int64)
    return _rows(key.astype(np.int64), none, order, at, none, none, end - at)


def _pooled(key, digest, order, at, windows, anchor) -> Iterator[pa.RecordBatch]:
    """Of equal contexts the earliest, the others as stretches to remove."""
    by = np.lexsort((at, order, digest, key))
    key, digest, order, at, windows, anchor = (
        column[by] for column in (key, digest, order, at, windows, anchor)
    )
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])
    again = _later(first, order, at)
    kept = ~again
    zero = np.zeros(int(kept.sum()), np.int64)
    yield _rows(key[kept], digest[kept], order[kept], at[kept], windows[kept], anchor[kept], zero)
    if again.any():
        ends = at[again] + windows[again] + LENGTH - 1
        yield _stretches(order[again], at[again], ends)


def _later(first: np.ndarray, order: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which rows of sorted groups start later than their group's first one."""
    head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    return (order != order[head]) | (at != at[head])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to contexts, equal ones of a pool of text reduced to the earliest."""
    pool: list[tuple] = []
    held = 0
    for batch in slices(batches, "text", PIECE_BYTES):
        orders, bases, pieces = [], [], []
        for order, text in zip(
            batch.column("ord").to_pylist(), batch.column("text").to_pylist(), strict=True
        ):
            for base, piece in _cut(text):
                orders.append(order)
                bases.append(base)
                pieces.append(piece)
        for few in _groups(pieces):
            piece, first, count, offset, key, digest = contexts([pieces[i] for i in few])
            order = np.array([orders[i] for i in few], np.int64)[piece]
            at = np.array([bases[i] for i in few], np.int64)[piece] + first
            pool.append((key.astype(np.int64), digest.astype(np.int64), order, at, count, offset))
            held += sum(len(pieces[i]) for i in few)
        if held >= POOL_BYTES:
            yield from _pooled(*map(np.concatenate, zip(*pool, strict=True)))
            pool, held = [], 0
    if pool:
        yield from _pooled(*map(np.concatenate, zip(*pool, strict=True)))


def _groups(pieces: list[bytes]) -> Iterator[range]:
    """Ranges of pieces that are looked through together."""
    first = total = 0
    for i, piece in enumerate(pieces):
        if total and total + len(piece) > 2 * PIECE_BYTES:
            yield range(first, i)
            first, total = i, 0
        total += len(piece)
    if first < len(pieces):
        yield range(first, len(pieces))


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts in the order of key, digest and place to what is known of them now.

    Of equal contexts all but the earliest are stretches to remove. An
    earliest one stays a context only if its key has another, different one.
    Between batches just the last context is held back, however many rows a
    key has.
    """
    held = np.zeros((6, 0), np.int64)  # the last first-of-equals, not yet decided
    held_many = False
    for batch in batches:
        columns = [batch.column(name).to_numpy() for name in _SCHEMA.names]
        stretch = columns[4] == 0
        if stretch.any():
            key, _, order, at, _, _, size = (column[stretch] for column in columns)
            zero = np.zeros(len(key), np.int64)
            yield _rows(key, zero, order, at, zero, zero, size)
        live = np.array([column[~stretch] for column in columns[:6]], np.int64)
        live = np.concatenate([held, live], axis=1)
        if not live.shape[1]:
            continue
        key, digest, order, at, windows, _ = live
        first = np.ones(live.shape[1], bool)
        first[1:] = (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])
        again = _later(first, order, at)
        if again.any():
            ends = at[again] + windows[again] + LENGTH - 1
            yield _stretches(order[again], at[again], ends)
        different = live[:, first]
        same_key = different[0][1:] == different[0][:-1]
        many = np.zeros(different.shape[1], bool)
        many[1:] |= same_key
        many[:-1] |= same_key
        many[0] |= held_many
        yield _decided(different[:, :-1][:, many[:-1]])
        held, held_many = different[:, -1:], bool(many[-1])
    if held_many:
        yield _decided(held)


def _decided(live: np.ndarray) -> pa.RecordBatch:
    return _rows(*live, np.zeros(live.shape[1], np.int64))


def _common(left: bytes, right: bytes) -> int:
    """Length of the longest common prefix."""
    size = min(len(left), len(right))
    apart = int.from_bytes(left[:size]) ^ int.from_bytes(right[:size])
    return size - (apart.bit_length() + 7) // 8


def _furthest(texts: list[bytes]) -> list[int]:
    """For each text the longest prefix that it shares with any other."""
    by = sorted(range(len(texts)), key=texts.__getitem__)
    most = [0] * len(texts)
    for a, b in zip(by, by[1:], strict=False):
        size = _common(texts[a], texts[b])
        most[a], most[b] = max(most[a], size), max(most[b], size)
    return most


Placed = tuple[bytes, int, int]  # a string, the order of its document, its position there


def _trimmed(group: list[tuple[int, int, int, bytes]]) -> list[Placed]:
    """What of the contexts of one anchor can be repeated in another of them.

    That is no more than the longest stretches they share on either side of
    the anchor, so a context with less than LENGTH of both is left out.
    """
    before = _furthest([text[:anchor][::-1] for _, _, anchor, text in group])
    after = _furthest([text[anchor:] for _, _, anchor, text in group])
    return [
        (text[anchor - a : anchor + b], order, at + anchor - a)
        for (order, at, anchor, text), a, b in zip(group, before, after, strict=True)
        if a + b >= LENGTH
    ]


def _windows(strings: list[Placed]) -> tuple[np.ndarray, ...]:
    """All windows of the strings, equal ones together: (order, at, later, position in the join).

    A suffix array of the strings brings windows that are equal next to each
    other; neighbours are compared in full. `later` marks those that start
    after the earliest of their equals.
    """
    texts = [text for text, _, _ in strings]
    joined = b"\0".join(texts)
    sizes = np.array([len(text) for text in texts], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    codes = np.frombuffer(joined, np.uint8).astype(np.int64) + 2
    codes[begin[1:] - 1] = 1
    order = np.array(suffix_array(np.r_[codes, 0]), np.int64)[1:]
    owner = np.repeat(np.arange(len(texts)), sizes + 1)[: len(codes)]
    whole = begin[owner] + sizes[owner] - np.arange(len(codes)) >= LENGTH
    order = order[whole[order]]
    view = np.ndarray(len(joined) - 7, "<u8", joined, strides=(1,))
    same = np.ones(max(len(order) - 1, 0), bool)
    for offset in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        lane = view[order + offset]
        same &= lane[1:] == lane[:-1]
    document = np.array([order for _, order, _ in strings], np.int64)[owner[order]]
    at = np.array([at for _, _, at in strings], np.int64)[owner[order]]
    at += order - begin[owner[order]]
    group = np.cumsum(np.r_[0, ~same]) if len(order) else order
    by = np.lexsort((at, document, group))
    document, at, group, order = document[by], at[by], group[by], order[by]
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    return document, at, _later(first, document, at), order, joined


def _decide_groups(groups: list[list[tuple[int, int, int, bytes]]]) -> Iterator[pa.RecordBatch]:
    """Stretches to remove within whole groups of contexts, one per anchor."""
    again: list[tuple[int, int, int]] = []
    strings: list[Placed] = []
    for group in groups:
        earliest: dict[bytes, tuple[int, int]] = {}
        for text, order, at in sorted(_trimmed(group), key=itemgetter(1, 2)):
            if earliest.setdefault(text, (order, at)) != (order, at):
                again.append((order, at, at + len(text)))
        if len(earliest) > 1:
            strings += [(text, order, at) for text, (order, at) in earliest.items()]
    if strings:
        order, at, later, _, _ = _windows(strings)
        yield _stretches(order[later], at[later], at[later] + LENGTH)
    if again:
        yield _stretches(*np.array(again, np.int64).T)


def _decide_part(part: list[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Of some contexts of large groups: stretches to remove, and each different window once."""
    order, at, later, where, joined = _windows([(text, order, at) for order, at, _, text in part])
    if later.any():
        yield _stretches(order[later], at[later], at[later] + LENGTH)
    kept = ~later
    digests = [xxhash.xxh3_128_digest(joined[i : i + LENGTH]) for i in where[kept].tolist()]
    halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    one = np.ones(len(halves), np.int64)
    yield _rows(halves[:, 0], halves[:, 1], order[kept], at[kept], one, one * 0, one * 0)


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts with their texts, sorted by `many` and key, in blocks of about BLOCK_BYTES."""

    def rows():
        for batch in batches:
            names = ("many", "key", "ord", "at", "anchor", "text")
            yield from zip(*(batch.column(name).to_pylist() for name in names), strict=True)

    groups, part, held = [], [], 0
    for (many, _), found in groupby(rows(), itemgetter(0, 1)):
        if many:
            for row in found:
                part.append(row[2:])
                held += len(row[5])
                if held >= BLOCK_BYTES:
                    yield from _decide_part(part)
                    part, held = [], 0
        else:
            groups.append([row[2:] for row in found])
            held += sum(len(row[3]) for row in groups[-1])
            if held >= BLOCK_BYTES:
                yield from _decide_groups(groups)
                groups, held = [], 0
    if groups:
        yield from _decide_groups(groups)
    if part:
        yield from _decide_part(part)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with the places of their contexts to these contexts with their bytes.

    A place is taken only from the text whose digest it has.
    """
    names = ("many", "key", "ord", "at", "anchor", "text")
    for batch in slices(batches, "text"):
        out: dict[str, list] = {name: [] for name in names}
        for order, text, wanted in zip(
            *(batch.column(name).to_pylist() for name in ("ord", "text", "wanted")), strict=True
        ):
            for place in wanted:
                at = place["at"]
                found = text[at : at + place["windows"] + LENGTH - 1]
                digest = xxhash.xxh3_64_intdigest(found)
                if digest == place["digest"] & 0xFFFFFFFFFFFFFFFF:
                    values = (place["many"], place["key"], order, at, place["anchor"], found)
                    for column, value in zip(out.values(), values, strict=True):
                        column.append(value)
        kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        arrays = [pa.array(x, kind) for x, kind in zip(out.values(), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, list(names))


def _settled(found: DataFrame) -> DataFrame:
    ordered = found.repartition("key").sortWithinPartitions("key", "digest", "ord", "at")
    return ordered.mapInArrow(_settle, _FOUND)


def repeated_stretches(docs: DataFrame) -> DataFrame:
    """(ord, at, size): bytes covered by a string that also starts earlier, in pieces.

    `docs` has `ord`, which orders the documents, and `text` as bytes.

    1. Every text is cut into contexts by anchors (`contexts`), and of equal
       contexts all but the earliest are removed: first among the texts of a
       task's pool, so that a passage of very many documents comes to the
       shuffle once per pool, then in all, in sorted order.
    2. Left are contexts whose anchor has others that differ from them. Their
       bytes are fetched, and those of an anchor come together. Whatever they
       can share is put into suffix arrays, where equal windows are neighbours.
    3. An anchor of more than GROUP contexts is not brought together. Its
       contexts are dealt out by document; a suffix array per block finds the
       windows repeated there, and each different window of a block goes on by
       its digest of 128 bits, to be settled like a context in step 1.
    """
    scanned = docs.where(F.octet_length("text") >= LENGTH).mapInArrow(_scan, _FOUND)
    settled = staged(_settled(scanned), "contexts")
    open_ones = settled.where("windows > 0").drop("size")
    large = open_ones.groupBy("key").count().where(F.col("count") > GROUP)
    large = large.select(F.col("key").alias("_key"))
    marked = open_ones.join(large, open_ones["key"] == large["_key"], "left")
    place = F.struct(
        F.col("_key").isNotNull().alias("many"), "key", "digest", "at", "windows", "anchor"
    )
    wanted = marked.groupBy("ord").agg(F.collect_list(place).alias("wanted"))
    fetched = docs.join(wanted, "ord").mapInArrow(
        _fetch, "many boolean, key long, ord long, at long, anchor int, text binary"
    )
    dealt = fetched.repartition(F.expr("if(many, xxhash64(ord, at), key)"))
    decided = staged(
        dealt.sortWithinPartitions("many", "key").mapInArrow(_decide, _FOUND), "decided"
    )
    rest = _settled(decided.where("windows > 0"))
    parts = [found.where("windows = 0").select("ord", "at", "size") for found in (settled, decided, rest)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, kept, spans) for every row of `docs`.

    Every byte goes that a string of LENGTH bytes covers which also starts
    earlier: in a document of smaller doc_id, or earlier in the same one. All
    strings are judged on the whole texts as they come, in UTF-8; none reaches
    across documents. `kept` are the other bytes, `spans` the removed runs, as
    (start, end) offsets; both may cut characters apart. Null and empty texts
    have no bytes, texts below LENGTH lose none. Every row is a document of its
    own: rows of one doc_id follow one another in the order of the XXH64 hash
    (seed 42, signed) of their texts, and rows without a doc_id come after all
    others, in the same order; of identical rows one is the first. An empty
    table gives no rows. Only `doc_id` and `text` are read, whatever other
    columns are called.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("tie")]
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        utf8("text").alias("text"),
        F.monotonically_increasing_id().alias("tie"),
    )
    # Sorted by ranges, the numbers that tasks give to their rows are the order of all rows.
    ordered = source.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    numbered = staged(ordered.withColumn("ord", F.monotonically_increasing_id()), "ordered")
    cuts = (
        repeated_stretches(numbered.select("ord", "text"))
        .groupBy("ord")
        .agg(F.collect_list(F.struct("at", "size")).alias("cuts"))
    )
    joined = numbered.join(cuts, "ord", "left")
    return joined.select("doc_id", "text", "cuts").mapInArrow(
        _apply,
        "doc_id long, n_bytes long, kept binary, spans array<struct<start: long, end: long>>",
    )


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("kept", pa.binary()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ]
    )
    for batch in slices(batches, "text"):
        rows = []
        for doc_id, text, cuts in zip(
            *(batch.column(name).to_pylist() for name in ("doc_id", "text", "cuts")), strict=True
        ):
            spans, parts, at = [], [], 0
            for start, size in sorted((cut["at"], cut["size"]) for cut in cuts or ()):
                end = min(start + size, len(text))
                if spans and start <= spans[-1]["end"]:
                    spans[-1]["end"] = max(end, spans[-1]["end"])
                elif start < end:
                    spans.append({"start": start, "end": end})
            for span in spans:
                parts.append(text[at : span["start"]])
                at = span["end"]
            kept = b"".join([*parts, text[at:]])
            rows.append({"doc_id": doc_id, "n_bytes": len(text), "kept": kept, "spans": spans})
        yield pa.RecordBatch.from_pylist(rows, schema)


def repeat_digest(docs: DataFrame) -> DataFrame:
    """`remove_repeats` with counts and a digest in place of bytes and spans."""
    return remove_repeats(docs).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
