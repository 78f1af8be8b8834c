import random

from tables import SMALL
from tidemark.llm import base, near_dup as q


def brute(rows, link=85):
    """Components by comparing the word shingles of all pairs that share one."""
    sets = {}
    for i, t in rows:
        w = [x.decode() for x in (t or "").encode().translate(bytes.maketrans(
            b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()]
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = {}
    for i in sorted(sets):
        seen = set()
        for g in sets[i]:
            for j in lists.setdefault(g, []):
                if j not in seen:
                    seen.add(j)
                    both = len(sets[i] & sets[j])
                    if 100 * both >= link * (len(sets[i]) + len(sets[j]) - both):
                        a, b = sorted((find(i), find(j)))
                        parent[b] = a
            lists[g].append(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def check(spark, docs_of, rows):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in q.near_duplicates(docs_of(rows)).collect()}
    assert got == brute(rows)


def test_whole_table_equals_brute_force(spark, docs_of):
    check(spark, docs_of, [(r["doc_id"], r["text"]) for r in base.table(spark, SMALL, "documents").collect()])


def test_large_near_copy_group_and_common_passage(spark, docs_of):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    origin = [word() for _ in range(150)]
    rows = []
    for i in range(400):  # near copies of all degrees, pairs on both sides of the threshold
        w = list(origin)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    passage = [word() for _ in range(80)]
    rows += [(1000 + i, " ".join([word() for _ in range(rng.randrange(4, 60))] + passage)) for i in range(200)]
    rows += [(2000 + i, " ".join(origin)) for i in range(100)]
    check(spark, docs_of, rows)


def test_edges(spark, docs_of):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "one two three"), (7, "É x"), (8, "é x"),
            (9, "w " * 20000), (10, "w " * 30000)]
    check(spark, docs_of, rows)
    out = q.near_duplicates(docs_of([(None, "a b c"), (3, "a b c"), (3, "a b c"), (4, "z z"), (5, "z z"), (5, "u")])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in out) == [
        (0, 3, False), (3, 3, True), (3, 3, True), (4, 4, True), (5, 4, False), (5, 5, True)]
    assert q.near_duplicates(docs_of([])).count() == 0
    kept = q.keep_one(docs_of(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 8, 9] and "kept" in kept.columns


def test_lower_threshold_equals_brute_force(spark, docs_of):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    origin = [word() for _ in range(150)]
    rows = []
    for i in range(150):  # near copies on both sides of 0.80
        w = list(origin)
        for _ in range(rng.randrange(0, 12)):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    passage = [word() for _ in range(80)]
    rows += [(1000 + i, " ".join([word() for _ in range(rng.randrange(4, 60))] + passage)) for i in range(100)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in q.near_duplicates(docs_of(rows), 80).collect()}
    assert got == brute(rows, 80) != brute(rows)
    assert (q._emitted(85), q._crowded_percent(85)) == (14, 65) and (q._emitted(80), q._crowded_percent(80)) == (19, 50)


def test_one_row_of_each_group_stays(spark, docs_of):
    """Null, repeated and conflicting ids: every text keeps exactly one row."""
    long = [f"x{i}" for i in range(120)]
    near = " ".join([*long[:118], "y", "z"])
    rows = [(None, "alone here"), (None, "twin text"), (None, "twin text"), (6, "shared words"), (6, "of its own"), (2, "shared words"),
            (7, "again"), (7, "again"), (None, "again"), (None, " ".join(long)), (9, near), (None, near), (8, None), (8, None), (None, "")]
    kept = q.keep_one(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted([
        (0, "alone here"), (0, "twin text"), (2, "shared words"), (6, "of its own"), (7, "again"), (9, near), (8, ""), (8, ""), (0, "")])
    links = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in q.near_duplicates(docs_of(rows)).collect()}
    assert (None, 116, 9, False) in links and (9, 116, 9, True) in links and (None, 1, None, True) in links
    assert q.keep_one(docs_of([])).count() == 0
