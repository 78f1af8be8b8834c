import random

from tables import TINY
from tidemark.llm import base, line_dedup as q


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute(rows):
    seen, out = [], {}
    occurrences = sorted((i, p, line.strip(q.BLANKS)) for i, t in rows for p, line in enumerate((t or "").split("\n")))
    for i, p, line in occurrences:
        if line:
            if any(line == s or min(len(s), len(line)) >= q.MIN_CHARS and one_edit(s, line) for s in seen):
                out.setdefault(i, []).append(p)
            seen.append(line)
    return out


def check(docs, rows):
    got = {r["doc_id"]: r["dropped"] for r in q.dropped_lines(docs).collect() if r["dropped"]}
    assert got == brute(rows)


def test_table_equals_brute_force(spark, docs_of):
    rows = [(r["doc_id"], r["text"]) for r in base.table(spark, TINY, "documents").limit(60).collect()]
    check(docs_of(rows), rows)


def test_edits_at_every_place(spark, docs_of):
    rng = random.Random(7)
    line = "".join(rng.choice("abcde fghiü") for _ in range(70)).strip()
    variants = [line]
    for k in range(len(line)):
        base_line = rng.choice(variants[-3:]) if k % 2 else line
        c = rng.choice("xyzß")
        variants.append(rng.choice([base_line[:k] + base_line[k + 1:], base_line[:k] + c + base_line[k:],
                                    base_line[:k] + c + base_line[k + 1:]]))
    variants += ["a" * n for n in range(20, 30)] + [line[:24], line[:23], line[:25], "x" + line[:23], "x" + line[:22]]
    rng.shuffle(variants)
    rows = [(i // 3, "\n".join(variants[i:i + 3])) for i in range(0, len(variants), 3)]
    check(docs_of(rows), rows)


def test_edges(spark, docs_of):
    long = "".join(chr(97 + i % 23) for i in range(60000))
    rows = [(1, None), (2, ""), (3, " \n\t\n"), (4, "short\nshort"), (5, " short \r\nshorx"), (6, long), (7, long[:30000] + "!" + long[30001:])]
    check(docs_of(rows), rows)
    twice = docs_of([(1, "same line here"), (1, "same line here"), (2, "same line here"), (None, "other")])
    assert sorted((r["doc_id"] or 0, r["dropped"]) for r in q.dropped_lines(twice).collect()) == [(0, []), (1, []), (1, []), (2, [0])]
    out = q.dedup_lines(twice)
    assert out.columns == twice.columns and sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 1, 1]
    cut = q.dedup_lines(docs_of([(1, "keep\n\nalso"), (2, "keep\n\nnew"), (3, "")])).collect()
    assert {(r["doc_id"], r["text"], r["n_chars"]) for r in cut} == {(1, "keep\n\nalso", 10), (2, "\nnew", 4), (3, "", 0)}
    assert q.dropped_lines(docs_of([])).count() == 0
