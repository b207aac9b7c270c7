import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyline.llm.disclosure import KINDS, base_spans, find_personal_data, op8_disclosure, sanitise, span_digests
from tests.llm import brute

PIECES = [*"a1234567890..@@+--  ()", "a@b.c", "255.", "4111111111111111", "é", "+1 (212) 555-0153", "\n", "0000"]


@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join))
@settings(max_examples=1500, deadline=None)
def test_base_spans(text):
    assert [(KINDS[k], s, e) for k, s, e in base_spans(text)] == brute.base_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "1 " * 100_000):
        base_spans(text)


def test_documents(spark):
    texts = brute.texts_of(spark, "/root/testdata/sf0.01")
    for r in op8_disclosure(spark, "/root/testdata/sf0.01").collect():
        spans = brute.base_spans(texts[r.doc_id])
        shown = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest() and r.spans.startswith(shown)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in spans) for kind in KINDS]


def story():
    rows = [(i, f"The report number {i} said that somebody went out again.\nNothing else there.") for i in range(300)]
    rows += [(1000 + i, f"Yesterday the Zorblatt, agent {i} of it, wrote from z.b@spy.org again.") for i in range(5)]
    # copies of one line: its rare words stand beside the address, but in one context only
    rows += [(2000 + i, "The quixotic plumber answers under p@pipes.net always.") for i in range(5)]
    rows += [(3000, "Zorblatt was seen.")]
    return rows


def test_terms_that_disclose(spark):
    docs = spark.createDataFrame(story(), "doc_id long, text string")
    texts = dict(story())
    terms = {}
    for r in span_digests(find_personal_data(docs)).collect():
        own = [s.split(":") for s in r.spans.split(",") if s.startswith("term:")]
        terms[r.doc_id] = {texts[r.doc_id][int(s) : int(e)] for _, s, e in own}
    assert all("Zorblatt" in terms[1000 + i] for i in range(5))
    assert all(not ({"The", "the", "again", "said", "went"} & t) for t in terms.values())
    assert all(not terms[2000 + i] for i in range(5)) and not terms[3000]
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert len(clean) == len(texts) and clean[3000] == "Zorblatt was seen." and clean[0] == texts[0]
    assert "<EMAIL>" in clean[1000] and "@" not in clean[1000] and "Zorblatt" not in clean[1000]
    assert clean[2000] == "The quixotic plumber answers under <EMAIL> always."


def test_edges(spark):
    docs = brute.edge_docs(spark, [(20, "a@b.cd and 1.2.3.4"), (20, "a@b.cd and 1.2.3.4"), (21, "é\U00013000 a@b.cd")])
    rows = span_digests(find_personal_data(docs)).collect()
    assert len(rows) == 16
    by_id = {r.doc_id: r for r in rows}
    assert by_id[20].spans == "email:0:6,ip:11:18" and by_id[21].spans == "email:3:9"
    nothing = hashlib.sha256(b"").hexdigest()
    assert {by_id[i].base_sha256 for i in (1, 2, 3, 4, 7, 9)} == {nothing} and by_id[1].spans == ""
    assert sanitise(docs).columns == docs.columns and sanitise(docs).count() == 16
    assert span_digests(find_personal_data(brute.empty_docs(spark))).count() == 0


def test_terms_on_other_lines_of_a_document_that_holds_the_entity(spark):
    rows = story()
    rows += [(4000, "z.b@spy.org\n\n“ZORBLATT” é was met\nby Zorblatt, and zorblatt/z.b@spy.org"), (4001, "p@pipes.net\nZorblatt")]
    texts = dict(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: [s.split(":")[1:] for s in r.spans.split(",") if s.startswith("term:")] for r in span_digests(find_personal_data(docs)).collect()}
    assert [texts[4000][int(s) : int(e)] for s, e in spans[4000]] == ["ZORBLATT", "Zorblatt"] and not spans[4001]
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert "zorblatt" not in clean[4000].split("and")[0].lower() and clean[4001] == "<EMAIL>\nZorblatt"


def test_words_beside_any_marks_are_counted(spark, monkeypatch):
    import re

    import numpy as np
    from pyspark.sql import functions as F

    from tallyline.llm import disclosure as D
    from tallyline.llm.blocks import word_spans

    text = "“Zorblatt” «a» ¿qué? …ok… 全角。 (x) --- ”…“ _u_ é́ \U0001f600ab\U0001f600 plain x²"
    data = np.frombuffer(text.encode(), np.uint8)
    got = [data[s:e].tobytes().decode() for s, e in zip(*D._trimmed(data, *word_spans(data, np.array([0, len(data)]))))]
    assert got == [m for m in (D._EDGE.match(w).group(1) for w in re.findall(r"\S+", text)) if m]

    rows = [(i, f"The report number {i} said that «somebody» went out…\n¿Nothing else there?") for i in range(300)]
    rows += [(1000 + i, f"Yesterday “Zorblatt”, agent {i} of somebody… wrote from z.b@spy.org again.") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("row"), F.col("doc_id").alias("id"), "text")
    places = D.find_base(keyed).select("row", F.explode("places").alias("p")).select("row", "p.context", "p.term")
    here = {r.term: r["count"] for r in places.distinct().groupBy("term").count().collect()}
    counted = {r.term: r.n for r in D.lines_with(docs, places.select("term").distinct()).collect()}
    assert here and all(counted.get(t, 0) >= n for t, n in here.items())
    texts, terms = dict(rows), set()
    for r in span_digests(find_personal_data(docs)).where("doc_id >= 1000").collect():
        terms |= {texts[r.doc_id][int(s.split(":")[1]) : int(s.split(":")[2])] for s in r.spans.split(",") if s.startswith("term:")}
    assert "Zorblatt" in terms and "somebody" not in terms
    monkeypatch.setattr(D, "BROADCAST_TERMS", 0)
    joined = span_digests(find_personal_data(docs)).where("doc_id >= 1000 and spans like '%term:%'")
    assert joined.count() == 5
