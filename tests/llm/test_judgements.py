"""Quality, language, line rules and URL rules."""

import random
import re

import duckdb
import pyarrow as pa
import pytest
from brute import judge_url
from conftest import SMALL, TABLES
from pyspark.sql import functions as F

from tallyhouse.llm import features, language_id, line_rules, oracle, quality_classifier, queries, url_rules
from tallyhouse.llm.text import as_block, blocks, gram_hash, read, text_crc


# --- Quality classifier -------------------------------------------------------------------------

def sample_texts(seed, n):
    draw, rows = random.Random(seed), []
    stem = ["river", "stone", "green", "walk", "light", "under", "morning", "house", "garden", "letter"]
    for i in range(n):
        words = [draw.choice(stem) + draw.choice(["", "s", "ed", "ing"]) for _ in range(draw.randrange(20, 80))]
        junk = draw.random() < 0.3
        kind = draw.randrange(3)
        if junk:
            words = ([w.upper() + "!!" for w in words], [w + draw.choice(["***", "$$$"]) for w in words],
                     [words[k // 12] for k in range(len(words))])[kind]
        rows.append((i, " ".join(words) + ".", int(not junk)))
    return rows


def test_quality_is_learned_from_the_rows_it_may_see(spark, frame):
    rows = sample_texts(1, 400)
    docs = frame([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, q, "x") for i, _, q in rows] + [(5, None, "x"), (None, 1, "x")],
                                   "doc_id bigint, quality int, text string")
    model = quality_classifier.fit(docs, labels, text_crc("doc_id") % 5 != 0)
    scores = {r.doc_id: r for r in quality_classifier.score(docs, model).collect()}
    assert len(scores) == len(rows)
    right = [scores[i].predicted == q for i, _, q in rows]
    assert sum(right) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scores.values())
    wrong = labels.withColumn("quality", F.when(text_crc("doc_id") % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality_classifier.fit(docs, wrong, text_crc("doc_id") % 5 != 0)
    assert (again.logits == model.logits).all()
    bounded = quality_classifier.fit(docs, labels, F.lit(True), max_training=10)
    assert bounded.logits.shape == model.logits.shape


def test_quality_of_odd_rows(spark, frame, odd_rows):
    docs = frame(odd_rows)
    model = quality_classifier.train([])
    scores = [r.score for r in quality_classifier.score(docs, model).collect()]
    assert scores == [0.5] * len(odd_rows)
    labels = spark.createDataFrame([(1, 1), (2, 0), (8, 1), (10, 0)], "doc_id bigint, quality int")
    model = quality_classifier.fit(docs, labels, F.lit(True))
    found = quality_classifier.score(docs, model).collect()
    assert len(found) == len(odd_rows)
    assert len({r.score for r in found if r.doc_id in (1, 2)}) == 1
    kept = quality_classifier.keep_accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in found)
    nothing = quality_classifier.fit(docs, labels.limit(0), F.lit(True))
    assert quality_classifier.score(frame([]), nothing).count() == 0


def test_grams_stay_within_documents():
    texts = ["abc", None, "", "abcd", "a b a b"]
    block = as_block(pa.array(texts))
    _, docs = features.character_grams(block, (2, 3), 1 << 10)
    assert [int((docs == d).sum()) for d in range(5)] == [3, 0, 0, 5, 11]
    _, docs = features.word_grams(block, (1, 2), 1 << 10)
    assert [int((docs == d).sum()) for d in range(5)] == [1, 0, 0, 1, 7]
    hashes = gram_hash(block.data, 4)
    assert len(hashes) == len(block.data) - 3


def test_blocks_hold_whole_documents():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "c" * 50, "", "d"])], ["text"])
    parts = list(blocks([batch.slice(0, 0), batch], "text", block_bytes=4))
    assert [b.raw(i) for _, b in parts for i in range(len(b))] == [b"ab", b"", b"c" * 50, b"", b"d"]
    assert sum(rows.num_rows for rows, _ in parts) == 5


# --- Language -----------------------------------------------------------------------------------

SAMPLES = {
    "en": "the house and the garden were with that of which they have been there when this is what",
    "de": "das haus und der garten waren nicht mit einem von dem sich auch aber wenn dies ist was",
    "fr": "la maison et le jardin etaient avec celui que nous avons dans les rues quand cela est une",
    "es": "la casa y el jardin estaban con aquel que nosotros tenemos en las calles cuando esto es una",
    "xx": "zub gro wak plim dro zak vrum klop brak zim glop wub drak plom",
}


def language_rows(seed, n):
    draw = random.Random(seed)
    return [(i, " ".join(draw.choice(SAMPLES[lang].split()) for _ in range(draw.randrange(8, 40))), lang)
            for i in range(n) for lang in [draw.choice(list(SAMPLES))]]


def test_languages_are_told_apart_family_first(spark):
    rows = language_rows(2, 500)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(docs, text_crc("id") % 4 != 2)
    assert model.families == ["germanic", "only xx", "romance"] and model.pairs == [("de", "en"), ("es", "fr")]
    found = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert sum(found[i].lang_pred == lang for i, _, lang in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_three_languages_of_one_family_vote(spark):
    rows = [(i, t, {"fr": "a", "es": "b", "en": "c"}.get(lang, "d")) for i, t, lang in language_rows(3, 300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(docs, F.lit(True), families=dict.fromkeys("abcd", "one"), max_per_language=40)
    assert len(model.pairs) == 6
    found = {r.doc_id: r.lang_pred for r in language_id.predict(docs, model).collect()}
    assert sum(found[i] == lang for i, _, lang in rows) >= 0.9 * len(rows)


def test_language_of_odd_rows(spark, frame, odd_rows):
    docs = spark.createDataFrame(language_rows(4, 60), "doc_id bigint, text string, lang string")
    model = language_id.fit(docs, F.lit(True))
    odd = frame(odd_rows + [(20, "123 456!"), (21, "ПРИВЕТ")])
    found = language_id.predict(odd, model).collect()
    assert len(found) == len(odd_rows) + 2
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3, 20))
    assert by_id[21].lang_pred in SAMPLES and by_id[8].lang_pred in SAMPLES
    nothing = language_id.fit(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in language_id.predict(odd, nothing).collect()} == {"und"}
    assert language_id.predict(frame([]), model).count() == 0


# --- Line rules ---------------------------------------------------------------------------------

def sql_answer(name, tables):
    con = duckdb.connect()
    for table, rows in tables.items():
        con.register(table, rows)
    cursor = con.execute(oracle.SQL[name])
    names = [c[0] for c in cursor.description]
    return [dict(zip(names, row)) for row in cursor.fetchall()]


def test_line_counts_of_odd_rows_equal_the_sql(frame, odd_rows):
    rows = odd_rows + [
        (30, "Home | News | About | Contact\nA proper line of prose with enough words to stay.\n" * 4),
        (31, "All Rights Reserved.\nNothing else is here but these ten words of prose, really."),
        (32, "one two three four five six seven eight nine ten"), (33, "line.\nline.\n\n \nline.\r\nline.\n"),
        (34, "THE WORDS!! SHOUT!! AT!! ALL!! OF!! US!! AND!! GO!! ON!! SO!!\nLast line says so, quietly; in peace."),
        (36, "One sentence ends here. The other one goes on without any end\nten words but no stop inside them at all, not one"),
        (37, "short. no end"), (38, "A stop at the very end of ten words counts too."),
        (35, "Er sagte: „Das ist gut.“ Sie sagte nichts dazu”\nUnd dann ging er weg, ohne ein Wort zu sagen…"),
    ]
    found = line_rules.clean_lines(frame(rows), with_text=False)
    expected = sql_answer("op7_line_rules", {"documents": pa.table({
        "doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows], pa.string())})})
    names = list(expected[0])
    order = lambda some: sorted(some, key=str)
    assert order([tuple(r[n] for n in names) for r in found.collect()]) == order(
        [tuple(r[n] for n in names) for r in expected])
    assert line_rules.clean_lines(frame([])).count() == 0


def test_failing_lines_leave_the_text(frame):
    good = "A proper line of prose with enough words to stay."
    other = "Another line says different things in other words!"
    text = f"{good}\nHome | News | About\nSubscribe to our letter.\n{other}\nno end"
    rows = {r.doc_id: r for r in line_rules.clean_lines(frame([(1, text), (2, None), (3, "no\nend")])).collect()}
    assert rows[1].clean_text == f"{good}\n{other}\n" and rows[1].kept
    assert (rows[1].n_lines, rows[1].n_bad_lines, rows[1].n_lost_words) == (5, 3, 11)
    assert rows[2].clean_text is None and not rows[2].kept and rows[3].clean_text == ""


# --- URL rules ----------------------------------------------------------------------------------

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"), ("org", "", "block"), ("a.org", "/x", "allow"),
         ("a.org", "/xy/z", "block"), ("b.a.org", "/xy", "allow"), ("com", "/en", "block")]


def test_the_longest_rule_wins(spark):
    draw = random.Random(5)
    hosts = ["example.com", "www.example.com", "a.www.example.com", "EXAMPLE.com", "badexample.com", "x.net", "net",
             "a.org", "b.a.org", "c.b.a.org", "org", "", "com", "a.org.evil.info", "com.", "a..org", "1.2.3.4:80"]
    paths = ["", "/", "/en", "/en/", "/en/a/b", "/es/", "/fr/x", "/x", "/xy", "/xy/z/1", "/x/en/"]
    rows = [(i % 80, f"http://{draw.choice(hosts)}{draw.choice(paths)}{draw.choice(['', '?a=/en/', '#/es/', '?q#f'])}")
            for i in range(600)]
    rows += [(1, None), (None, None), (None, "http://a.org/x"), (2, ""), (3, "a.org/x"), (4, "x://y://a.org/x"),
             (5, "http://a.org/x"), (5, "http://a.org/x"), (6, "http://a.org\n/x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr(
        "*", "'h' as host", "'p' as path", "'k' as key", "'s' as slot", "1 as copies", "'r' as rule")
    rules = spark.createDataFrame(RULES + [("a.org", "/x", "allow"), (None, "/", "block"), ("q.org", "/", None)],
                                  "host string, path string, verdict string")
    found = url_rules.judge_urls(pages, rules, slots=7)
    expected = [(i, *judge_url(u, RULES, "allow")) for i, u in rows]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    assert {r.verdict for r in url_rules.judge_urls(pages, rules.limit(0), default="block").collect()} == {"block"}
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0


def test_url_rules_use_no_python_on_the_main_path(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    plan = url_rules.judge_urls(read(spark, SMALL, "pages"), rules)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|BroadcastNestedLoop|Cartesian", plan)


# --- Given tables -------------------------------------------------------------------------------

def test_held_out_quality_and_language(spark):
    labels = read(spark, TABLES, "labels")
    scored = queries.QUERIES["op1_quality"](spark, TABLES).join(labels, "doc_id").filter("held_out")
    assert scored.filter("predicted = quality").count() >= 0.95 * scored.count()
    docs = read(spark, TABLES, "documents").select("doc_id", "lang")
    found = queries.QUERIES["op9_language"](spark, TABLES).join(docs, "doc_id").filter("held_out")
    assert found.filter("lang_pred = lang").count() >= 0.97 * found.count()


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_queries_equal_their_sql(spark, name):
    from oracle import compare, connect  # the helper of tests/, not the module of SQL texts

    assert compare(spark, connect(SMALL), SMALL, queries.QUERIES[name], oracle.SQL[name]) is None
