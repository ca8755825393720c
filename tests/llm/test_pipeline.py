import numpy as np
from brute import groups, repeated_lines

import corpus_pipeline as pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows():
    rng = np.random.default_rng(8)
    voc = {"en": ["the", "shall", "thing", "owner", "wheat", "other"], "de": ["über", "schlich", "keit", "zwei", "ungen", "pfau"]}
    out = []
    for i in range(60):
        lang = "en" if i % 3 else "de"
        out.append([i, "\n".join(" ".join(w + str(rng.choice(list("abcdefghijk"))) for w in rng.choice(voc[lang], 12)) for _ in range(5)), lang, f"s{i % 4}"])
    out += [[100 + i, out[i][1], out[i][2], "s0"] for i in range(5)]  # copies
    out += [[110 + i, out[10 + i][1].replace(" ", "  ", 3).replace("\n", " "), out[10 + i][2], "s1"] for i in range(5)]  # equal words, other lines
    out += [[120, None, "en", "s0"], [121, "", None, None], [122, "123 456", "en", None]]
    return [(*r, len(r[1]) if r[1] is not None else None) for r in out]


def frame(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_in_turn(spark):
    docs, data = frame(spark, rows()), {r[0]: r[1] for r in rows()}
    for (name, stage), step in zip(pipeline.STAGES, range(5), strict=True):
        docs = stage(spark, docs, "").cache()
        if step < 4:
            assert docs.columns == COLUMNS, name
        got = {r.doc_id: r.text for r in docs.collect()} if step < 4 else None
        if step == 0:
            data = {i: t for i, t in data.items() if i < 120}
            assert got == data
        elif step == 1:
            gone = repeated_lines(data, 2, 50)
            data = {i: "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[i]) for i, t in data.items()}
            data = {i: t for i, t in data.items() if t.strip(" ")}
            assert got == data and not any(100 <= i < 110 for i in got)
        elif step == 2:
            root, _ = groups(data, 5, 80, 100)
            data = {i: t for i, t in data.items() if root[i] == i}
            assert got == data and not any(110 <= i < 120 for i in got)
        elif step == 3:
            assert set(got) <= set(data) and docs.count() >= len(got)
            mixed = [r.doc_id for r in docs.select("doc_id").collect()]
            assert max(mixed.count(i) for i in set(mixed)) <= 3
        else:
            assert sorted(r.doc_id for r in docs.filter("start = 0").collect()) == sorted(mixed)


def test_stages_on_nothing_and_on_repeated_rows(spark):
    for data in ([], rows()[:3] * 2 + [(None, "only words here", None, None, 1)] * 2):
        docs = frame(spark, data)
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, "").cache()
        assert docs.count() >= (1 if data else 0)


CLASHES = ["score", "lang_pred", "lang_mix", "_found", "n_touched", "_runs", "_at", "_id", "_hash", "_id2", "_hash2", "_clean", "target", "copies", "_copy",
           "_row", "n", "_size", "_order", "taken", "source_size", "component_id", "text_hash", "stays", "n_shingles", "src_id", "_text", "held.out"]


def test_foreign_columns_are_carried(spark):
    """Columns that operators use for themselves come out of every stage as they went in."""
    data = [r for r in rows() if r[0] is not None]
    names = COLUMNS + CLASHES
    docs = spark.createDataFrame([(*r, *(f"{c} of {r[0]}" for c in CLASHES)) for r in data], "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{c}` string" for c in CLASHES))
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "").cache()
        assert docs.columns == names, name
        found = docs.collect()
        assert found and all(list(r)[5:] == [f"{c} of {r.doc_id}" for c in CLASHES] for r in found), name
    assert pipeline.STAGES[-1][1](spark, docs, "").count() >= docs.count()
