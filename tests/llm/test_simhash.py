"""SimHash near-duplicates against all pairs."""

import re

import llm_cases as cases
import numpy as np
import pytest
import xxhash
from tradewind.llm import queries, simhash
from tradewind.llm.components import components


def plain_print(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return 0
    shingles = [words[i : i + 3] for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids):
    """Smallest id reachable over links of 3 bits or fewer, by all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(prints)):
        groups.setdefault(find(i), []).append(ids[i])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [least[find(i)] for i in range(len(prints))]


def expected(rows):
    prints = [plain_print(r[1]) for r in rows]
    found = plain_components(prints, [r[0] for r in rows])
    return sorted(
        ((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, found, strict=True)), key=repr
    )


def test_query_equals_all_pairs(spark, tmp_path):
    folder = cases.stored_documents(cases.table(spark), tmp_path)
    got = queries.op1_simhash_pivots(spark, folder)
    assert cases.tuples(got, "doc_id", "fingerprint", "component_id") == expected(cases.rows())


def test_empty_table(spark):
    assert simhash.near_duplicates(cases.empty(spark)).collect() == []
    assert simhash.one_of_each(cases.empty(spark)).collect() == []


def near_prints(n, seed):
    """Fingerprints in tight families, some of which chain from one to the next."""
    pick = np.random.default_rng(seed)
    out, at = [], int(pick.integers(0, 2**63))
    for _ in range(n):
        if pick.random() < 0.1:
            at = int(pick.integers(0, 2**63)) | (int(pick.integers(0, 2)) << 63)
        for bit in pick.integers(0, 64, pick.integers(0, 4)):
            at ^= 1 << int(bit)
        out.append(at)
    return sorted(set(out))


@pytest.mark.parametrize("block_rows", [1024, 4])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, block_rows):
    """With small cells too, where every block of copies is cut."""
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block_rows)
    prints = near_prints(400, 3)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    rooted = components(simhash.print_links(spark.createDataFrame(signed, "fp long")))
    root = {r.node: r.root for r in rooted.collect()}
    want = plain_components(prints, [s[0] for s in signed])
    by_root, by_want = {}, {}
    for (s,), w in zip(signed, want, strict=True):
        by_root.setdefault(root.get(s, s), set()).add(s)
        by_want.setdefault(w, set()).add(s)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_want.values()))


def test_masks_leave_one_untouched():
    masks = [m & (2**64 - 1) for m in simhash.band_masks(3)]
    pick = np.random.default_rng(5)
    for _ in range(500):
        flips = sum(1 << int(b) for b in pick.choice(64, 3, replace=False))
        assert any(mask & flips == 0 for mask in masks)


def test_search_on_a_dense_ball():
    """A block in which most fingerprints are linked gives a spanning forest, not all pairs."""
    pick = np.random.default_rng(1)
    prints = np.unique(
        np.array([sum(1 << int(b) for b in pick.choice(30, 2)) for _ in range(300)], np.uint64)
    )
    table = simhash.distance_table(prints, simhash.pivots())
    links = simhash._search(prints, table, 3)
    assert len(links) == len(prints) - 1
    assert all(int(prints[a] ^ prints[b]).bit_count() <= 3 for a, b in links)


def test_pivot_distances_never_discard_a_link():
    pick = np.random.default_rng(2)
    a = pick.integers(0, 2**63, 500, dtype=np.uint64)
    b = a.copy()
    for i in range(500):
        for bit in pick.choice(64, 3, replace=False):
            b[i] ^= np.uint64(1 << int(bit))
    refs = simhash.pivots()
    apart = np.abs(simhash.distance_table(a, refs) - simhash.distance_table(b, refs))
    assert apart.max() <= 3


def test_one_of_each_keeps_the_smallest_id(spark):
    rows = cases.rows()
    got = simhash.one_of_each(cases.table(spark))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    # Groups by the number of their first row, as rows of several groups may share an id.
    prints = [plain_print(r[1]) for r in rows]
    groups = {}
    for row, group in zip(rows, plain_components(prints, range(len(rows))), strict=True):
        groups.setdefault(group, []).append(row)
    kept = [tuple(r) for r in got.collect()]
    for members in groups.values():
        least = min((m[0] for m in members if m[0] is not None), default=None)
        stay = [k for k in kept if k in members]
        assert len(stay) == 1 and stay[0][0] == least
    assert len(kept) == len(groups)


def test_columns_with_clashing_names(spark):
    docs = cases.table(spark).selectExpr(
        "*", "1 AS fp", "2 AS least", "3 AS node", "4 AS component_id", "5 AS root"
    )
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    assert got.count() == simhash.one_of_each(cases.table(spark)).count()


def test_rows_that_share_an_id_across_groups(spark):
    """One row of each group stays, although the groups' least id is the same."""
    a, b = cases.prose(41, 120), cases.prose(42, 120)
    rows = [(1, a, "en", "x", 1), (1, b, "en", "y", 1), (5, a, "en", "z", 1), (6, b, "en", "z", 1)]
    rows += [(None, cases.prose(43, 90), "en", "n", i) for i in range(3)]
    rows += [(None, "another one without an id", "en", "n", 1)]
    kept = [tuple(r) for r in simhash.one_of_each(cases.table(spark, rows)).collect()]
    assert sorted(r[:3] for r in kept if r[0]) == sorted(r[:3] for r in rows[:2])
    nameless = {r[1] for r in rows if r[0] is None}
    assert sorted(r[1] for r in kept if r[0] is None) == sorted(nameless)
