"""SimHash components against all pairs."""

from __future__ import annotations

import random

import xxhash

from tremorlane.llm.common import staged
from tremorlane.llm.components import connected_components
from tremorlane.llm.simhash import ball_links, drop_near_copies, fingerprint, simhash_components


def plain_fingerprint(text: str) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for gap in "\t\n\v\f\r":
        low = low.replace(gap, " ")
    words = [word for word in low.split(" ") if word]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    root = {node: node for node in nodes}

    def find(node):
        while root[node] != node:
            root[node] = root[root[node]]
            node = root[node]
        return node

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {node: find(node) for node in nodes}


def test_fingerprints_and_components(odd_docs, odd_rows):
    result = simhash_components(odd_docs).collect()
    assert len(result) == len(odd_rows)
    prints = {doc_id: plain_fingerprint(text or "") for doc_id, text in odd_rows}
    named = [doc_id for doc_id in prints if doc_id is not None]
    expected = components(named, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    for row in result:
        if row["doc_id"] is not None:
            assert row["fingerprint"] == f"{prints[row['doc_id']]:016x}"
            assert row["component_id"] == expected[row["doc_id"]]
    assert {row["component_id"] for row in result if row["doc_id"] in (3, 4, 5)} == {3}


def test_long_text_counts_every_shingle():
    random.seed(4)
    text = " ".join(random.choice("abcdefg") * random.randint(1, 4) for _ in range(70_000))
    assert fingerprint(text.encode()) & (1 << 64) - 1 == plain_fingerprint(text)


def test_links_join_all_within_two_bits(shipped):
    random.seed(5)
    base = [random.getrandbits(64) for _ in range(6)]
    values = {0, 1, 3, 7, (1 << 64) - 1}
    for value in base:
        for _ in range(12):
            for _ in range(random.randint(0, 3)):
                value ^= 1 << random.randrange(64)
            values.add(value)
    signed = [value - (1 << 64) if value >> 63 else value for value in values]
    table = shipped.createDataFrame([(value,) for value in signed], "fp long")
    links = staged(ball_links(table), "links")
    for a, b in links.collect():
        assert 0 < ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
    stars = {row["u"]: row["v"] for row in connected_components(links).collect()}
    near = components(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    assert {node: stars.get(node, node) for node in signed} == near


def test_chain_and_star_components(shipped):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 400)] + [(5, 5)]
    table = shipped.createDataFrame(pairs, "a long, b long")
    found = {row["u"]: row["v"] for row in connected_components(table).collect()}
    assert found == {i: 100 for i in range(101, 161)} | {i: 7 for i in range(300, 400)}


def test_one_of_a_group_stays(docs_of, no_docs):
    text = "one two three four five six seven eight nine ten"
    other = "another text of other words here"
    rows = [(5, text), (2, text.upper()), (9, other), (None, text), (2, "third of its id"), (2, text)]
    docs = docs_of([*rows, (None, "no id, and alone"), (11, None), (12, " \n"), (9, other)])
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    found = sorted(((row["doc_id"] or 0), (row["text"] or "").split()[:1]) for row in kept.collect())
    ones = (["one"], ["ONE"])
    assert [x for x in found if x[1] not in ones] == [(0, ["no"]), (2, ["third"]), (9, ["another"]), (11, [])]
    assert [x[0] for x in found if x[1] in ones] == [2]
    assert drop_near_copies(no_docs).count() == 0
    assert simhash_components(no_docs).count() == 0
