"""What the driver collects of a benchmark stays within its bound."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest

from tremorlane.llm.decontaminate import (
    PATTERN_BYTES,
    _blocks,
    contamination,
    drop_contaminated,
)

MOST = 4000
LONG = " ".join(f"long{i}" for i in range(700))


@pytest.mark.parametrize(
    "items",
    [
        [(1, "one item of some few words that comes very often indeed")] * 300 + [(2, "other")],
        [(1, LONG)],
        [(i, "the same window in all of the items that there are") for i in range(300)],
    ],
)
def test_blocks_are_bounded(shipped, docs_of, items):
    benchmark = shipped.createDataFrame(items, "item_id long, text string")
    found = []
    for block in _blocks(benchmark, 10, MOST):
        table = pa.ipc.open_stream(block().value).read_all()
        rows = [(row["item_id"], row["window"]) for row in table.to_pylist()]
        assert sum(len(window) + len(item_id) for item_id, window in rows) <= MOST
        found += rows
    assert len(found) == len(set(found))
    docs = docs_of([(1, f"before {items[0][1]} after"), (2, "nothing of that"), (3, None)])
    hit = {row["doc_id"]: row for row in contamination(docs.where("doc_id < 3"), benchmark).collect()}
    assert hit[1]["n_hit"] == len(items[0][1].split()) and hit[2]["n_hit"] == 0
    assert set(hit[1]["items"]) >= {"1"} or items[0][0] == 0
    assert sorted(row["doc_id"] for row in drop_contaminated(docs, benchmark).collect()) == [2, 3]


def test_a_large_benchmark_is_one_automaton(shipped, docs_of):
    """20,000 items; the texts are read once, and every occurrence is found."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    opening = "which of the following statements is true about the"
    items = [(i, f"{opening} {' '.join(rng.choices(words, k=rng.randint(3, 50)))}") for i in range(20_000)]
    items += [(20_000 + i, " ".join(rng.choices(words, k=4))) for i in range(50)]
    rows = []
    for i in range(120):
        text = rng.choices(words, k=rng.randint(0, 80))
        for _ in range(rng.randint(0, 2)):
            found = rng.choice(items)[1].split()
            at = rng.randint(0, max(0, len(found) - 10))
            cut = rng.randint(0, len(text))
            text[cut:cut] = found[at : at + rng.randint(8, 14)]
        rows.append((i, ", ".join(text).upper()))
    benchmark = shipped.createDataFrame(items, "item_id long, text string")
    assert len(list(_blocks(benchmark, 10, PATTERN_BYTES))) == 1
    docs = docs_of(rows)
    result = contamination(docs, benchmark)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # the texts are read once and not written
    owners = {}
    for item_id, text in items:
        own = text.split()
        for i in range(max(1, len(own) - 9)):
            owners.setdefault(tuple(own[i : i + 10]), set()).add(str(item_id))
    lengths = sorted({len(key) for key in owners})
    hit = 0
    for row in result.collect():
        own = dict(rows)[row["doc_id"]].lower().split(", ")
        inside, ids = set(), set()
        for i in range(len(own)):
            for n in lengths:
                found = owners.get(tuple(own[i : i + n])) if i + n <= len(own) else None
                if found:
                    inside.update(range(i, i + n))
                    ids |= found
        assert (row["n_hit"], row["items"]) == (len(inside), sorted(ids))
        hit += bool(inside)
    assert 20 < hit < 120
