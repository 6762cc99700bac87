"""The registered queries against their SQL, and the pipeline stage by stage against plain retellings."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tarnlake.llm import decontaminate, minhash_dedup, quality_rules, registry
from tarnlake.llm.common import stored, table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables absent")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {t.stem} AS SELECT * FROM '{t}'")
    return con


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    from tools.check import compare

    assert compare(duck, name, entry_points.queries()[name](spark, FOLDER), entry_points.oracle_sql()[name])[1] == []


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in entry_points.queries()


def test_native_queries_run_no_python(spark):
    for name in ("op3_decontaminate", "op6_quality_rules"):
        plan = entry_points.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_pipeline_stages(spark):
    import duckdb

    # The smallest tables have too few labels for a fit.
    folder, duck = "/root/testdata/sf0.01", duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    duck.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{folder}/benchmark.parquet'")
    docs = table(spark, folder, "documents")
    columns = docs.columns
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], folder), f"test-{name}"))
    for df in kept[1:-1]:
        assert df.columns == columns
    ids = [sorted(r.doc_id for r in df.select("doc_id").collect()) for df in kept]
    judged = duck.execute(f"SELECT doc_id FROM ({quality_rules.judged_sql()}) WHERE kept").fetchall()
    assert ids[1] == sorted(r[0] for r in judged)
    duck.register("kept_1", kept[1].toArrow())
    # The stage takes five words and 80 %.
    groups = duck.execute(minhash_dedup.ORACLE.replace("85 *", "80 *").replace("FROM documents", "FROM kept_1")).fetchall()
    assert ids[2] == sorted({r[2] for r in groups})
    duck.register("kept_2", kept[2].toArrow())
    hits = duck.execute(decontaminate.ORACLE.replace("FROM documents", "FROM kept_2")).fetchall()
    assert ids[3] == sorted(r[0] for r in hits if not r[5])
    clean = {r[0] for r in duck.execute(f"SELECT doc_id FROM '{folder}/labels.parquet' WHERE toxic = 0").fetchall()} & set(ids[3])
    assert set(ids[4]) <= set(ids[3]) and len(clean & set(ids[4])) > 0.93 * len(clean)
    assert set(ids[5]) == set(ids[4]) and kept[5].select("slot").distinct().count() == kept[5].count()
    assert entry_points.queries()["pipeline"](spark, folder).count() == kept[5].count()


def test_the_pipeline_leaves_its_result_only(spark):
    """Of all steps only the shards, their rows and their list are there after a run."""
    from tarnlake.session import shared_folder

    root = Path(shared_folder(spark).removeprefix("file:"))
    before = {p.name for p in root.iterdir()}
    left = corpus_pipeline.run(spark, "/root/testdata/sf0.01")
    kinds = {p.name.rsplit("-", 1)[0] for p in root.iterdir() if p.name not in before and not p.name.startswith(".") and "-" in p.name}
    assert kinds == {"sequences", "manifest", "shards"} and left.count() > 0


@pytest.mark.parametrize("toxic", [3, 100])
def test_the_mixture_loses_no_clean_document(spark, docs, prose, tmp_path, toxic):
    import collections

    plain = [(i, f"{prose(i, 40)} fine") for i in range(300)]
    odd = [(1000 + i, f"{prose(1000 + i, 40)} horrid nasty") for i in range(toxic)]
    clean_by_label = [(2000 + i, f"{prose(2000 + i, 40)} horrid nasty") for i in range(10)] if toxic > 10 else []
    rows = [*plain, *odd, *clean_by_label, (3000, None), (None, f"{prose(5, 40)} fine")]
    labels = [(i, int(1000 <= i < 2000)) for i, _ in plain + odd if i % 3] + [(i, 0) for i, _ in clean_by_label] + [(1, None)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.mixture(spark, docs(rows), str(tmp_path))
    assert out.columns == docs(rows).columns
    got = collections.Counter(r.doc_id for r in out.select("doc_id").collect())
    assert {i for i, _ in rows} - {i for i, _ in odd} <= set(got)
    # Few toxic documents are not repeated; too many are thinned.
    few = sum(got[i] for i, _ in odd)
    assert few == toxic if toxic < 10 else few < toxic / 2
    assert toxic > 10 or max(got.values()) == 1


def test_the_mixture_keeps_the_clean_labels_of_the_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    docs = table(spark, folder, "documents")
    clean = table(spark, folder, "labels").filter("toxic = 0").join(docs.select("doc_id"), "doc_id", "left_semi").select("doc_id").distinct()
    assert clean.count() > 100 and clean.join(corpus_pipeline.mixture(spark, docs, folder), "doc_id", "left_anti").isEmpty()


def texts():
    import duckdb

    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())


def test_page_texts_equal_a_plain_reading_of_these_pages(spark):
    import html
    import re

    import duckdb

    got = {r.page_id: (r.text, r.n_chars) for r in entry_points.queries()["op1_html_extraction"](spark, FOLDER).collect()}
    for page, source in duckdb.sql(f"SELECT page_id, html FROM '{FOLDER}/pages.parquet'").fetchall():
        body = re.search(r"<article>(.*)</article>", source or "", re.S)
        parts = re.split(r"</?(?:p|h1)>", body[1].replace("<br>", " ")) if body else []
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
        want = "\n".join(x for x in lines if x)
        assert got[page] == (want, len(want))


def test_token_counts_of_the_documents(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in entry_points.queries()["op5_token_counts"](spark, FOLDER).collect()}
    for i, t in texts().items():
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 2048)


def test_paragraphs_that_are_equal_are_found(spark):
    import collections

    where = collections.defaultdict(list)
    for i, t in texts().items():
        for k, line in enumerate((t or "").split("\n")):
            if len(line.split()) >= 40:
                where[line].append((i, k))
    got = {(r.doc_id, r.paragraph): r for r in entry_points.queries()["op9_substring_dedup"](spark, FOLDER).collect()}
    for places in where.values():
        if len(places) > 1:
            assert len({(got[p].first_doc_id, got[p].first_paragraph) for p in places}) == 1
            assert all(got[p].cluster_size >= len(places) for p in places)
    kept = [r for r in got.values() if not r.removed]
    assert len(kept) == len({(r.first_doc_id, r.first_paragraph) for r in got.values()})


def test_quality_scores_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    scored = entry_points.queries()["op10_quality_classifier"](spark, folder)
    assert scored.count() == table(spark, folder, "documents").count()
    judged = scored.filter("held_out").join(table(spark, folder, "labels"), "doc_id").collect()
    assert len(judged) > 50 and sum(r.predicted == r.quality for r in judged) >= 0.95 * len(judged)


def test_every_document_has_a_shard_and_its_slots(spark):
    placed = entry_points.queries()["op4_sharding"](spark, FOLDER)
    assert placed.count() == len(texts()) and placed.filter("shard is null").isEmpty()
    slots = entry_points.queries()["op8_token_shards"](spark, FOLDER)
    assert sorted(r.slot for r in slots.select("slot").collect()) == list(range(slots.count()))
    assert {r.doc_id for r in slots.select("doc_id").distinct().collect()} == set(texts())
