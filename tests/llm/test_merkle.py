"""The manifest against a tree that is built level by level."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest

from tremorlane.llm.merkle import (
    Subtrees,
    folded,
    joined,
    manifest_digest,
    merkle_manifest,
    verified,
)


def plain_hash(parts) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, added: int = 0) -> str:
    doc_id, source, lang, n_chars, text = row
    if n_chars is not None:
        n_chars += added
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return plain_hash("-" if v is None else f"{len(v.encode())}:{v}" for v in values)


def plain_tree(nodes: list[str]) -> tuple[str, list[list[str]], list[list[tuple[str, int] | None]]]:
    """The root, and for each node its siblings, with the side they are on."""
    proofs, steps = [[] for _ in nodes], [[] for _ in nodes]
    places = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(places):
            other = place ^ 1
            found = (nodes[other], place & 1) if other < len(nodes) else None
            steps[i].append(found)
            if found:
                proofs[i].append(found[0])
        nodes = [plain_hash(nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        places = [place // 2 for place in places]
    return nodes[0], proofs, steps


def plain_fold(node: str, steps) -> str:
    for step in steps:
        if step is None:
            node = plain_hash([node])
        else:
            node = plain_hash([step[0], node] if step[1] else [node, step[0]])
    return node


def plain_manifest(rows) -> list[tuple]:
    """Rows (doc_id, source, lang, n_chars, text) to what the query returns."""
    langs = sorted({row[2] for row in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = [row for row in rows if row[2] == lang]
        own.sort(key=lambda row: (row[0] is not None, row[0] or 0, plain_leaf(row)))
        trees[lang] = own, *plain_tree([plain_leaf(row) for row in own])
    root, top_proofs, top_steps = plain_tree([trees[lang][1] for lang in langs])
    out = []
    for lang, high, above in zip(langs, top_proofs, top_steps, strict=True):
        own, subroot, proofs, steps = trees[lang]
        for row, low, step in zip(own, proofs, steps, strict=True):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            fold = plain_fold(plain_leaf(row, hit), [*step, *above])
            proof = plain_hash([*low, *high])
            out.append((row[0] or -1, plain_leaf(row), subroot, root, proof, fold, fold == root))
    return sorted(out)


SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, place long, witness long, tree long, root int, node int, size int"


@pytest.fixture(scope="module")
def make(shipped):
    def of(rows):
        return shipped.createDataFrame([(*row, *[None] * 6) for row in rows], SCHEMA).repartition(3)

    return of


def result(table) -> list[tuple]:
    return sorted((row[0] or -1, *row[1:]) for row in table.collect())


@pytest.mark.parametrize("count", [1, 2, 3, 5, 8, 21, 64, 65])
def test_appending_keeps_every_witness(count):
    nodes = [sha256(bytes([i])).digest() for i in range(count)]
    trees = Subtrees()
    for node in nodes:
        trees.append(node)
    root = trees.close()
    expected, proofs, _ = plain_tree([node.hex() for node in nodes])
    assert root.hex() == expected
    assert [bytes(w).hex() for w in trees.witnesses] == ["".join(proof) for proof in proofs]
    for place, node in enumerate(nodes):
        assert folded(node, trees.witnesses[place], place, count) == root
        assert folded(joined(node), trees.witnesses[place], place, count) != root


def test_block_roots_are_appended_like_nodes():
    nodes = [sha256(bytes([i])).digest() for i in range(21)]
    above = Subtrees()
    for first in range(0, 21, 8):
        block = Subtrees()
        for node in nodes[first : first + 8]:
            block.append(node)
        above.append(block.close(3))
    assert above.close().hex() == plain_tree([node.hex() for node in nodes])[0]


@pytest.mark.parametrize("height", [1, 2, 12])
def test_table(make, monkeypatch, height):
    rows = [(i, f"s{i % 3}", ("de", "en", "é", None, "")[i % 7 % 5], i, f"text {i}") for i in range(90)]
    rows += [
        (None, None, None, None, None),
        (None, "s", "en", 1, "no id"),
        (3, "s0", "é", None, "a second row of this id"),
        (7, None, "zz", 5, ""),
        (200, "s", "en", 2, "twice"),
        (200, "s", "en", 2, "twice"),
        (201, "s", "en", 40_000, "é long " * 20_000),
    ]
    monkeypatch.setattr(merkle_manifest, "__kwdefaults__", {**merkle_manifest.__kwdefaults__, "height": height})
    assert result(manifest_digest(make(rows))) == plain_manifest(rows)


def test_one_row_and_none(make):
    rows = [(5, "s", "en", 3, "one")]
    found = result(manifest_digest(make(rows)))
    assert found == plain_manifest(rows)
    assert found[0][4] == sha256(b"").hexdigest()
    assert manifest_digest(make([])).count() == 0


def test_any_changed_row_is_found(make):
    rows = [(i, "s", "en", i, f"text {i}") for i in range(30)]
    manifest = merkle_manifest(make(rows), height=3)
    checked = verified(manifest).collect()
    assert len(checked) == 30 and all(row["folded_root"] == row["root"] for row in checked)
    swapped = verified(manifest.withColumn("leaf", manifest["subroot"])).collect()
    assert all(row["folded_root"] != row["root"] for row in swapped)
