import corpus_pipeline
from tables import TINY
from test_near_dup import brute as near_brute
from test_packing import check as packing_check

from tidemark.llm import base, line_dedup, mixing, quality_rules


def test_stages_follow_each_other(spark):
    docs = base.table(spark, TINY, "documents")
    columns, out = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = out
        out = base.staged(stage(spark, before, TINY), "stage")
        assert out.columns == columns, name
        if name == "quality rules":
            kept = quality_rules.quality_rules(before, base.table(spark, TINY, "labels")).where("kept")
            assert sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r in kept.collect())
        elif name == "line dedup":
            gone = {r["doc_id"]: set(r["dropped"]) for r in line_dedup.dropped_lines(before).collect()}
            want = {}
            for r in before.collect():
                parts = [x for i, x in enumerate(r["text"].split("\n")) if i not in gone[r["doc_id"]]]
                if any(p.strip() for p in parts):
                    want[r["doc_id"]] = "\n".join(parts)
            assert {r["doc_id"]: r["text"] for r in out.collect()} == want
        elif name == "near duplicates":
            found = near_brute([(r["doc_id"], r["text"]) for r in before.collect()], 80)
            assert sorted(r["doc_id"] for r in out.collect()) == sorted(i for i, (_, c) in found.items() if i == c)
        else:
            passes = {r["doc_id"]: r["passes"] for r in mixing.mix(before).collect()}
            got: dict = {}
            for r in out.collect():
                got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
            assert got == {i: n for i, n in passes.items() if n}
    once = out.dropDuplicates(["doc_id"])
    packed = corpus_pipeline.STAGES[-1][1](spark, once, TINY).collect()
    packing_check([(r["doc_id"], r["text"]) for r in once.collect()], packed)


def test_near_duplicates_link_from_four_fifths(spark, docs_of):
    rows = []
    for i in range(0, 40, 2):  # 104 words, 100 shingles; a last part of 5 to 24 words differs
        own = [f"w{i}x{j}" for j in range(104)]
        rows += [(i, " ".join(own)), (i + 1, " ".join(own[:99 - i // 2] + [f"v{i}x{j}" for j in range(5 + i // 2)]))]
    out = corpus_pipeline.near_duplicates(spark, docs_of(rows), TINY)
    found = near_brute(rows, 80)
    want = sorted(i for i, (_, c) in found.items() if i == c)
    assert sorted(r["doc_id"] for r in out.collect()) == want
    assert len(want) < sum(i == c for i, (_, c) in near_brute(rows, 85).items())


def test_stages_with_awkward_rows(spark):
    """Null values in any column, empty texts, ties, repeated rows, clashing further columns and empty
    tables: every stage keeps its columns, and only the mix, which takes shares, loses unlike texts."""
    extra = "_d int, d int, t int, tag string, carried int, passes int, dropped int, ls int, label int, gone int, kept int"
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}"
    prose = [" ".join(f"{chr(97 + k % 26)}{k * j % 97}word{j}" for j in range(80)) for k in range(12)]
    rows = [(k if k % 4 else None, t, "en" if k % 3 else None, "a" if k % 2 else None, len(t)) for k, t in enumerate(prose)]
    rows += [rows[1], rows[1], (1, prose[2] + " more", "en", "a", 0), (None, prose[4], None, None, None),
             (50, None, None, None, None), (50, "", "en", "b", 0), (51, " \n ", "en", "b", 3)]
    make = lambda rs: spark.createDataFrame([(*r, *[3] * 3, "x", *[5] * 7) for r in rs], schema)
    for table in (rows, []):
        docs = make(table)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = base.staged(stage(spark, docs, TINY), "stage")
            assert out.columns == docs.columns, name
            if table and name != "mixture":
                assert {r["text"] for r in out.collect()} >= set(prose[:1] + prose[5:]), name
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, TINY)
        assert (packed.count() > 0) == bool(table)
