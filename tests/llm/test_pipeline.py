import pandas as pd

import corpus_pipeline
from carelattice.llm import packing, pii
from carelattice.llm.common import table
from carelattice.llm.queries import tokenizer_path
from tests.llm import test_decontaminate, test_simhash
from tests.llm.test_pii import naive


def test_stages_equal_brute_force(spark, sf_dir):
    """Every stage is held against a plain computation on its own input."""
    columns = table(spark, sf_dir, "documents").columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash", "decontaminate", "pii", "packing"]
    docs = table(spark, sf_dir, "documents").unionByName(spark.createDataFrame(
        [(9001, None, "en", "s", 0), (9002, "123 !", "en", "s", 5), (9003, "of a@b.cd", None, None, 9), (9003, "of a@b.cd", None, None, 9)],
        table(spark, sf_dir, "documents").schema))
    stages = dict(corpus_pipeline.STAGES)

    before = docs.toPandas()
    kept = stages["language_id"](spark, docs, sf_dir)
    assert kept.columns == columns
    after = kept.toPandas()
    letters = before[[any(c.isalpha() for c in t or "") for t in before.text]]
    assert sorted(after.doc_id) == sorted(letters.doc_id)

    docs, before = kept, after
    kept = stages["simhash"](spark, docs, sf_dir)
    prints = {int(i): test_simhash.naive(t) for i, t in zip(before.doc_id, before.text)}
    roots = test_simhash.brute(set(prints.values()), 4)
    classes = {}
    for i, p in prints.items():
        classes.setdefault(roots[p], []).append(i)
    after = kept.toPandas()
    assert kept.columns == columns and sorted(after.doc_id) == sorted(min(c) for c in classes.values())
    assert len(after) < len(before)

    docs, before = kept, after
    kept = stages["decontaminate"](spark, docs, sf_dir)
    items = pd.read_parquet(f"{sf_dir}/benchmark.parquet")
    want = test_decontaminate.brute(list(zip(before.doc_id, before.text)), list(zip(items.item_id, items.text)))
    after = kept.toPandas()
    assert kept.columns == columns and sorted(after.doc_id) == sorted(r[0] for r in want if not r[4])

    docs, before = kept, after
    kept = stages["pii"](spark, docs, sf_dir)
    after = kept.toPandas()
    assert kept.columns == columns and kept.schema == docs.schema and len(after) == len(before)
    texts = dict(zip(after.doc_id, after.text))
    for i, text in zip(before.doc_id, before.text):
        assert texts[i] == pii.masked(text, {}) and not naive(texts[i])
    assert (after.n_chars == after.text.str.len()).all()

    pieces = stages["packing"](spark, kept, sf_dir).toPandas()
    words = packing.encoder(tokenizer_path())
    for i, text in texts.items():
        assert pieces[pieces.doc_id == i].length.sum() == len(words.encode([text.encode()])[0]) // 4 + 1


def test_run_and_empty_input(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 100
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.collect() == []
        docs = out if "text" in out.columns else docs


def test_extra_columns_keep_their_values(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(40).selectExpr(
        "*", *[f"concat('x', doc_id) as `{c}`" for c in ("row", "_row", "text_key", "bad_id", "score", "id", "spans")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.where("row <> concat('x', doc_id) or _row <> row or text_key <> row or spans <> row").count() == 0
    assert docs.count() > 10


def test_one_row_of_every_class_whatever_the_ids(spark, sf_dir):
    """Ids with two texts and rows without an id: a class keeps one row, and no class is lost."""
    def prose(seed):
        return " ".join(f"w{(seed * 7919 + i * i * 31) % 100_003}" for i in range(60))

    clean, other, third, fourth = (prose(s) for s in (1, 2, 3, 4))
    texts = [(3, other), (None, other), (None, third), (None, third), (None, fourth)]
    for seven in ([(7, clean), (7, other)], [(7, clean), (7, clean.upper()), (7, fourth)]):
        rows = [(i, t, "en", "s", len(t)) for i, t in texts + seven]
        docs = spark.createDataFrame(rows, table(spark, sf_dir, "documents").schema)
        kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()
        got = sorted(((r["doc_id"], r["text"].lower()) for r in kept), key=repr)
        assert got == sorted([(3, other), (7, clean), (None, third),
                              ((7 if len(seven) == 3 else None), fourth)], key=repr)


def test_passages_of_unnamed_items_contaminate(spark, tmp_path):
    passage = " ".join(f"p{i}" for i in range(15))
    spark.createDataFrame([(None, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, passage), (2, "a b c")], "doc_id bigint, text string")
    assert [r["doc_id"] for r in corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()] == [2]
