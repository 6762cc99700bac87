"""Operators that treat each row alone: quality rules, token counts, page text, sharding."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from tarnlake.llm import page_text, quality_rules, sharding, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")


def brute_repeats(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    count = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    return len({j for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)})


def test_quality_counts_equal_brute_force(docs):
    r = random.Random(3)
    texts = [" ".join(r.choice("ab") for _ in range(n)) for n in (0, 1, 2, 3, 4, 7, 12, 40)]
    texts += [None, "", "  \t\n ", "x\x0by\x1cz", "a b c a b c", "a\n\nb\na\n \na", "#*$ %&| <>", "é ñ ß\x85ü"]
    got = quality_rules.judge(docs(list(enumerate(texts)))).orderBy("doc_id").collect()
    for row, t in zip(got, texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert row.n_words == len(w) and row.word_chars == sum(map(len, w))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", t or ""))
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == brute_repeats(t), t
        assert row.base_failed is True and row.kept is False and row.lang == "en"


def test_quality_verdicts(docs, prose):
    good = " ".join(f"the {w} of" for w in prose(1, 60).split())
    rows = docs([(1, good), (2, re.sub(r"(\w+)", r"\1!!", good.upper())), (3, re.sub(r"(\w+)", r"\1$$$", good)), (4, "go on and on " * 60), (5, good), (5, good)])
    kept = [(r.doc_id, r.kept) for r in quality_rules.judge(rows).orderBy("doc_id").collect()]
    assert kept == [(1, True), (2, False), (3, False), (4, False), (5, True), (5, True)]
    assert quality_rules.judge(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        quality_rules.judge(rows.drop("text"))


def test_a_rule_bounds_a_ratio_with_ties_passing(docs):
    rule = [quality_rules.Rule("half", "n_symbols", "n_words", None, 500)]
    rows = docs([(1, "# a " * 30), (2, "# a " * 30 + "#")])
    out = quality_rules.text_counts(rows).withColumn("ok", quality_rules.verdict(rule)).orderBy("doc_id").collect()
    assert [r.ok for r in out] == [True, False]


def test_quality_runs_without_python(docs):
    plan = quality_rules.judge(docs([(1, "a")])).drop("kept")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEval" not in plan and "BatchEval" not in plan


def test_token_counts_equal_the_library(docs, prose):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = [None, "", " ", "Hello, WORLD don't 123", prose(2, 300), "x" * 3000, "<|endoftext|>hi<|startoftext|> <|ENDOFTEXT|>",
             "ΣΑΣ İ ß ﬁ é é", "日本語 👨‍👩‍👧 नमस्ते", "a\x1cb\x85c e", "''s 'S 're'", "a_b__c...!!!"]
    got = token_counts.count_tokens(docs(list(enumerate(texts))), path).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert got[0].kept == "x"


def test_every_letter_is_lowered_as_by_the_library():
    """The whole code space but surrogates, each letter between two others."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, count = Tokenizer.from_file(path), token_counts.TokenCounter(token_counts.load_merges(path))
    letters = [chr(c) for c in (*range(0xD800), *range(0xE000, 0x20000))]
    texts = ["".join(f"a{c}b " for c in letters[k : k + 8]) for k in range(0, len(letters), 8)]
    wrong = [t for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False)) if count(t) != len(e.ids)]
    assert wrong == []


def test_merging_pops_the_lowest_rank_first():
    ranks = {("b", "c"): 0, ("a", "b"): 1, ("a", "bc"): 2, ("abc", "a"): 3}
    assert token_counts.merge_count(list("abcabc"), ranks) == 4
    assert token_counts.merge_count([], ranks) == token_counts.merge_count(["a"], ranks) == 0
    assert token_counts.merge_count(list("aaa"), {("a", "a"): 0}) == 1


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<nav><ul><li><a href=/>Home</a><li><a href=/x>More</a></ul></nav><div class="cookie-note notice">We use cookies here and there.</div>
<article><header><h1>A &amp; B</h1></header><p><b>First&nbsp;one<br>goes
 on<p>Hm.</p><!-- <p>hidden</p> --><aside>By the way</aside><p>See <a href=y>this page</a> for all of it.</p>
<form><label>Name</label><input name=n></form><section id="comments"><p>I liked it very much indeed, thank you.</p></section></article>
<div class="sidebar">Side</div><footer>&copy; us</footer></body></html>"""


def test_main_text_of_a_page(spark):
    pages = spark.createDataFrame(
        [(1, PAGE, "old"), (2, None, "old"), (3, "", "old"), (4, "<p>", "old"), (5, "<article><p>a<p>b &lt;i&gt; &#233;", "old"),
         (6, "<script>never closed <article><p>x", "old"), (1, PAGE, "old")], "page_id long, html string, text string")
    got = {r.page_id: r.text for r in page_text.extract(pages).collect()}
    assert got == {1: "A & B\nFirst one goes on\nHm.\nSee this page for all of it.", 2: "", 3: "", 4: "", 5: "a\nb <i> é", 6: ""}
    assert page_text.extract(pages).count() == 7 and page_text.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("page", [
    "<html class='no-social'><body class='sidebar-right'><article><p>{}</article></body></html>",
    "<div class='main with-sidebar'><article><p>{}</article></div>", "<div class='post related-stories-page'><main><p>{}</main></div>",
    "<main class='has-sidebar'><p>{}</main>", "<article><p title='the hidden truth'>{}</article>", "<article><p data-hidden='false'>{}</article>",
    "<article><p><a href='/hidden-gems'></a>{}</article>", "<article><p data-class='menu' title='class=menu id=ads'>{}</article>"])
def test_attributes_do_not_hide_an_article(page):
    said = "It was a long day and so they went on until it grew dark over the hills"
    assert page_text.main_text(page.format(said), page_text.trained()) == said


LONG = "They went on for many hours until the road came to an end and nobody could say where it had been going. " * 2


@pytest.mark.parametrize("page,kept", [
    ("<article><p>{}</p><p>Yes, he did.</p></article><nav><a>Home</a></nav>", [LONG, "Yes, he did."]),
    ("<article><p>{}</p><p>Yes, he did.</p></article><footer><a>Home</a></footer>", [LONG, "Yes, he did."]),
    # The tree overrules a doubtful name, and lists that nothing names.
    ("<article><h1>A</h1><div class='legal-analysis'><p>{}</p><p>So it was.</p></div></article>", ["A", LONG, "So it was."]),
    ("<article><div class='post social-history'><p>{}</p></div></article>", [LONG]),
    ("<article><p>{}</p><ul><li><a>Read this next</a></li><li><a>And that after it</a></li><li><a>And more</a></li></ul></article>", [LONG]),
    ("<article><p>{0}</p><section class='user-feedback'><p>{0}</p><p>nice</p></section></article>", [LONG]),
    ("<article><p>{0}</p><div class=comment-list><p>{0}</p></div></article>", [LONG]),
    # Pages without an article element.
    ("<div class=nav><a>Home</a><a>More</a></div><div class=content><h1>T</h1><p>{}</p><p>The end.</p></div><div class=footer>us</div>", ["T", LONG, "The end."]),
    ("<div><a>Home</a></div><div><h1>Title here</h1><p>{0}</p><p>{0}</p></div><div><a>About us</a></div>", ["Title here", LONG, LONG]),
    ("<div class='alert-mechanisms'><p>{}</p></div><div class=sidebar><p>{}</p></div>".replace("{}", "{0}"), [LONG])])
def test_words_and_links_weigh_more_than_names(page, kept):
    assert page_text.main_text(page.format(LONG), page_text.trained()).split("\n") == [k.strip() for k in kept]


def test_site_parts_stay_out():
    page = ("<div class='sidebar'><p>Side words here</div><article><p>One two three<section id=comments><article><p>I like it</article></section>"
            "<p hidden>No</p><p class=x hidden=''>No</p></article><nav><article>Teaser</article></nav>")
    assert page_text.main_text(page, page_text.trained()) == "One two three"


def test_the_tree_tells_the_labelled_blocks_apart():
    tree = page_text.trained()
    right = total = 0
    for page in page_text.LABELLED:
        rows = page_text.features([page_text.Block("", w, k, p, h, n) for p, n, h, w, k, _ in page])
        right += sum(page_text.belongs(tree, row) == bool(b[5]) for row, b in zip(rows, page))
        total += len(page)
    assert right >= 0.97 * total


def test_deep_and_long_pages_are_read_whole():
    page = "<article>" + "<div>" * 20_000 + "x " * 20_000 + "</span>" * 20_000 + "<p>end"
    assert page_text.main_text(page, page_text.trained()).endswith("\nend")


def test_lookup_table_follows_its_definition():
    names = [f"s{k}" for k in range(7)]
    owner = sharding.fill(names, 101)
    # Plain retelling: each shard's whole order of preference, shards in turn.
    orders = [[(sharding.draw(f"offset:{s}") + j * (sharding.draw(f"skip:{s}") % 100 + 1)) % 101 for j in range(101)] for s in names]
    want, turn = {}, 0
    while len(want) < 101:
        want[next(x for x in orders[turn % 7] if x not in want)] = turn % 7
        turn += 1
    assert owner == [want[k] for k in range(101)]
    sizes = collections.Counter(owner).values()
    assert max(sizes) - min(sizes) <= 1
    fewer = sharding.fill(names[:-1], 101)
    assert sum(names[a] != names[b] for a, b in zip(owner, fewer) if names[a] != "s6") < 30
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill(bad, 101)
    with pytest.raises(ValueError):
        sharding.fill(names, 100)


def test_placement(spark, docs):
    rows = docs([(i, "t") for i in range(2000)] + [(None, "t"), (5, "u"), (5, "u")]).withColumn("slot", F.lit("old"))
    out = sharding.place(rows, "doc_id", ["a", "b", "c"])
    assert out.count() == 2003 and out.filter("shard is null").count() == 0
    assert out.filter("doc_id = 5").select("shard").distinct().count() == 1
    shares = {r.shard: r["count"] for r in out.groupBy("shard").count().collect()}
    assert min(shares.values()) > 550
    assert sharding.place(rows.limit(0), "doc_id", ["a"]).count() == 0
    import hashlib

    owner = sharding.fill(["a", "b", "c"])
    for r in out.limit(20).collect():
        key = "null" if r.doc_id is None else str(r.doc_id)
        assert r.shard == ["a", "b", "c"][owner[int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % sharding.SLOTS]]
