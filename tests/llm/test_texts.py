"""Byte-level BPE, personal data, toxicity, main text, urls, chat formatting, and the pipeline."""
from __future__ import annotations

import hashlib
import random
import re
import time

import duckdb
import pytest

import corpus_pipeline
from shelfrisk.llm import byte_bpe, html_text, ngram_join, pii, preference_chat, toxicity, url_rules
from shelfrisk.llm.common import table
from shelfrisk.llm.queries import ORACLE, QUERIES

SMOKE = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, score double, spans string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1.0, "s") for r in rows], DOCS)


# --- byte-level BPE


@pytest.fixture(scope="module")
def reference_encoder():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(byte_bpe.vocabulary_path()), special_tokens={})


def test_bpe_equals_the_reference_encoder(reference_encoder):
    encoder = byte_bpe.Encoder(byte_bpe.vocabulary_path())
    rng = random.Random(4)
    parts = ["a", "thing", "'s", "'re", "'", "''", " ", "  ", "\n", "\t ", "é", "ß", "7", "２", "!!", "'ll ", "日本", "🙂", "it's", "\x85", "\u200b", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(1500)]
    texts += ["", "a" * 3000, "ab" * 2000, " " * 500, "".join(rng.choice("abcdeéß") for _ in range(5000))]
    for text in texts:
        ids = encoder.encode(text)
        assert ids == reference_encoder.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_bpe_digests(spark, reference_encoder):
    rows = [(1, "Hello there, world's end!"), (2, ""), (None, None), (3, "x" * 5000 + " tail"), (1, "Hello there, world's end!")]
    got = sorted(map(tuple, byte_bpe.encode_digests(docs(spark, rows)).collect()), key=repr)
    expected = []
    for d, t in rows:
        ids = reference_encoder.encode_ordinary(t or "")
        expected.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(expected, key=repr)
    full = byte_bpe.encode_ids(docs(spark, rows)).collect()
    assert all(bytes(r.decoded).decode() == (t or "") for r, (_, t) in zip(full, rows, strict=True))
    assert byte_bpe.encode_digests(docs(spark, rows).limit(0)).collect() == []


# --- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = pii.only_digits(m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 2, m.end()))
    return sorted(out + [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(pii.only_digits(m[0])) <= 15])


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(8)
    for _ in range(20_000):
        text = "".join(rng.choice("1234.@+- ()ab0.@é\n") for _ in range(rng.randrange(30)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_long_runs_take_no_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000, "+1" + "(" * 200_000, "a@" * 100_000, "1 " * 100_000,
                 "token" + " " * 200_000, "token = " * 50_000, "a" * 200_000 + "=", "token=" + "x" * 200_000, "a.b" * 70_000 + "[at]", "-" * 200_000 + "=", "x[at]y" + ".zz" * 70_000):
        start = time.monotonic()
        pii.loose_spans(text, pii.base_spans(text))
        assert time.monotonic() - start < 5, text[:5]


def test_secrets_and_mistyped_cards_are_added_by_the_method(spark):
    hexes = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(40)]
    rows = [(i, f'Before it token = "{h}" and after.') for i, h in enumerate(hexes)] + [(100 + i, f"paid with card 4{i:03d}123412341234 then") for i in range(40)]
    rows += [(200, "token = notthat"), (201, "the key: opening times and numbers"), (202, "no = \"" + hexes[0] + "\""), (203, "db_password: s3cretWord99 x"), (204, "12345678901 and 12345678901234567890")]
    df = docs(spark, rows)
    got = {r.doc_id: r for r in pii.pii(spark, df).collect()}
    for i, h in enumerate(hexes):
        at = rows[i][1].index(h)
        assert got[i].spans.split(",")[-1] == f"secret:{at}:{at + 40}" and got[i].base_sha256 == hashlib.sha256(pii.listed(pii.base_spans(rows[i][1])).encode()).hexdigest()
    assert all(got[100 + i].spans == "card:15:31" for i in range(40)) and sum(got[100 + i].n_card for i in range(40)) == 4  # of the base only those with a right check digit
    assert [got[i].spans for i in (200, 201, 202, 204)] == [""] * 4
    assert all(pii.all_spans(text, None)[1] == pii.base_spans(text) for _, text in rows)  # without the classifier nothing is added
    clean = {r.doc_id: r.text for r in pii.without_personal_data(spark, df).collect()}
    assert clean[0] == 'Before it token = "[SECRET]" and after.' and clean[101] == "paid with card [CARD] then"


def test_labelers_add_spans_and_masks(spark):
    rows = [(i, f"call me: tel (030) 1234-{5000 + i} or +49 30 {1234567 + i} today") for i in range(30)]
    rows += [(100 + i, f"write to jane{i} [at] mail [dot] com or bob{i}@mail.com") for i in range(30)]
    rows += [(200, "nothing here"), (201, ""), (None, None), (202, "card 4111 1111 1111 1111, host 10.0.0.1, é 🙂 a@b.cc")]
    df = docs(spark, rows)
    got = {r.doc_id: r for r in pii.pii(spark, df).collect()}
    assert got[202].spans == "card:5:24,ip:31:39,email:45:51" and (got[202].n_email, got[202].n_ip, got[202].n_card, got[202].n_phone) == (1, 1, 1, 0)
    assert got[None].spans == "" and got[None].base_sha256 == hashlib.sha256(b"").hexdigest()
    for d, r in got.items():
        base = plain_spans(dict(rows)[d] or "")
        assert r.base_sha256 == hashlib.sha256(pii.listed(base).encode()).hexdigest()
        assert set(pii.listed(base).split(",")) <= set(r.spans.split(","))
    assert got[3].spans.count("phone") == 2 and got[103].spans.count("email") == 2
    out = pii.without_personal_data(spark, df)
    assert out.columns == df.columns
    masked = {r.doc_id: r.text for r in out.collect()}
    assert masked[202] == "card [CARD], host [IP], é 🙂 [EMAIL]" and masked[200] == "nothing here" and masked[None] is None
    assert pii.pii(spark, df.limit(0)).collect() == [] and pii.without_personal_data(spark, df.limit(0)).collect() == []


def test_em_finds_the_unreliable_labeler():
    rng = random.Random(1)
    seen = {}
    for _ in range(4000):
        true = rng.random() < 0.4
        vote = "".join(("y" if (rng.random() < p) == true else "n") for p in (0.95, 0.9, 0.9, 0.5))
        seen[vote] = seen.get(vote, 0) + 1
    prior, rates, _ = pii.reliabilities(sorted(seen.items()))
    assert abs(prior - 0.4) < 0.05 and rates[0][0] > 0.9 > 0.6 > rates[0][3] > 0.4


# --- toxicity


def test_grammar_reads_clauses():
    classes = toxicity.Classes({"idiot$": 2.0}, [0.1, 0.8, 1.6, 2.4])

    def kinds(text):
        codes = bytes(map(classes.__getitem__, toxicity.TOKEN.findall(text.lower())))
        return [toxicity.KINDS[k] for clause in codes.split(b".") for k, _ in toxicity.clause_match(clause, classes.weights)]

    assert kinds("What an idiot.") == ["insult"]
    assert kinds("You IDIOT!") == ["targeted"]
    assert kinds("He is not an idiot") == ["negated"]
    assert kinds("not that we would ever call him one: idiot") == ["insult"]
    assert kinds("She wrote that one is an idiot") == ["reported"]
    assert kinds("I will kill you. Kill the process.") == ["threat", "wish"]
    assert kinds("a clear day") == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.op2_toxicity(spark, sf).filter("held_out").join(table(spark, sf, "labels"), "doc_id").select("toxic", "predicted", "score").collect()
    toxic = [r for r in got if r.toxic == 1]
    clean = [r for r in got if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)
    assert all(0 <= r.score <= 1 for r in got)


def test_toxicity_without_labels_and_with_odd_rows(spark):
    rows = [(1, "you are an idiot and a moron"), (2, "a fine day"), (None, None), (3, ""), (1, "you are an idiot and a moron"), (4, "word " * 50_000)]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(spark, docs(spark, rows), labels).collect()
    assert len(got) == 6 and {r.doc_id: r.predicted for r in got} == {1: 1, 2: 0, None: 0, 3: 0, 4: 0}
    kept = toxicity.without_toxic(spark, docs(spark, rows), labels)
    assert kept.columns == ["doc_id", "text", "score", "spans"] and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 4]
    null_labels = spark.createDataFrame([(None, 1, 1), (1, 0, None), (2, 0, 0), (1, 0, 1), (1, 0, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(spark, docs(spark, rows), null_labels).count() == 6
    assert toxicity.toxicity(spark, docs(spark, rows).limit(0), labels).collect() == []


# --- main text


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b<br>c &#233;", "a\n\nb c é"),
    ("<nav><a href=x>m</a></nav><h1>T</h1><p>" + "w " * 60 + "<p>ok</p><footer>f</footer>", "T\n\n" + " ".join(["w"] * 60) + "\n\nok"),
    ("<div class='side-bar sidebar'>x</div><article><header><h1>T</h1></header><p>one</p><div class=ad>buy</div><p>two</p></article><div id=comments><p>" + "c " * 400 + "</div>", "T\n\none\n\ntwo"),
    ("<script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no --><form><p>no</p></form><p>yes  and\n no</p>", "yes and no"),
    ("<p>cut off <a href='x", "cut off"), ("<ul><li><a href=a>only</a></li><li><a href=b>links</a></li></ul>", ""), ("< 3 and <3 <p>x", "< 3 and <3\n\nx"),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


LONG = " ".join(["w"] * 60)


@pytest.mark.parametrize("gap", ["<div class=ad>buy</div>", "<aside>see also</aside><div class=notice>n</div>", "<nav>1</nav><nav>2</nav><nav>3</nav><nav>4</nav>"])
def test_barren_lines_in_mid_text_cut_nothing_off(gap):
    assert html_text.main_text(f"<h1>T</h1><p>{LONG}</p>{gap}<p>{LONG} x</p><p>ok</p><footer>f</footer>") == f"T\n\n{LONG}\n\n{LONG} x\n\nok"
    assert html_text.main_text(f"<h1>T</h1><p>a</p>{gap}<p>b</p>") == "T\n\na\n\nb"  # no surge on the page


def test_windows_decide_where_text_begins_and_ends():
    assert html_text.stretches([9, 0, 0, 0, 5, 80, 0, 0, 4, 0, 0, 0, 30, 30, 30]) == [(4, 9), (12, 15)]
    assert html_text.stretches([9, 0, 0, 0, 5]) == [(0, 1), (4, 5)] and html_text.stretches([0, 0]) == []


@pytest.mark.parametrize("page,text", [
    ("<div style='overflow:hidden'><article><p>one</p><div style=\"overflow: hidden\">two</div></article></div>", "one\n\ntwo"),
    ("<div>menu text</div><article><p>" + "long " * 60 + "</p></article><nav>x</nav><p>between</p><article><h2>Second</h2><p>short</p></article>",
     " ".join(["long"] * 60) + "\n\nSecond\n\nshort"),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be so.</p></article>", "Let x=1 be so."),
    ("<article hidden=false data-id='comments' title=\"a class='ad' role=menu\"><p data-id='comments'>one</p><p hidden=\"false\">two</p></article>", "one\n\ntwo"),
    ("<article><p>one</p><p hidden>no</p><p class = ad>no</p><p data-x=1 ID='comments'>no</p><p aria-hidden=\"true\">no</p><p hidden=''>no</p></article>", "one"),
    ("<html><head><meta charset=x><title>t</title><body><h1>T</h1><p>one</p>", "T\n\none"), ("<head><title>t</title><p>one<p>two", "one\n\ntwo"),
    ("<head><title>t</title>\n one<p>two", "one\n\ntwo"), ("<head><title>t</title></head><p>one", "one"), ("<head><script>x</script><header>no</header><p>one", "one"),
    ("<article><h1><a href=x>Title</a></h1><p>one</p><ol><li><a href=a>Reference</a><li><a href=b>Another</a></ol></article>", "Title\n\none\n\nReference\n\nAnother"),
    ("<main><p><a href=x>linked</a></main><p><a href=y>beside</a>", "linked"), ("<p>one<p><a href=y>menu</a>", "one"),
    ("<datalist id=d><option value=1>a<option value=2>b</datalist><p>one</p>", "one"), ("<option>a<optgroup label=x></optgroup><p>one</p>", "one"), ("<option>a<p>one</p>", "one"),
    ("<select><option>a<option>b</select><p>one</p>", "one"),
])
def test_only_barren_parts_are_barren(page, text):
    assert html_text.main_text(page) == text


def test_pages_give_their_articles(spark):
    got = {r.page_id: r for r in html_text.op7_html_text(spark, SMOKE).collect()}
    for r in table(spark, SMOKE, "pages").collect():
        article = r.html[r.html.index("<article>") : r.html.index("</article>")]
        blocks = [" ".join(expected_text.split()) for expected_text in map(_plain, re.split(r"</?(?:p|h1|article)>", article))]
        assert got[r.page_id].text == "\n\n".join(filter(None, blocks)) and got[r.page_id].n_chars == len(got[r.page_id].text)
    odd = spark.createDataFrame([(None, None, None, "c"), (1, "u", "<p>x</p>", "c"), (1, "u", "<p>x</p>", "c")], "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, r.text) for r in html_text.extract(odd).collect()) == [(0, ""), (1, "x"), (1, "x")]
    assert html_text.extract(odd.limit(0)).collect() == []


def _plain(block):
    import html

    return html.unescape(re.sub(r"<[^>]*>", " ", block))


# --- urls and chats


def test_url_rules(spark):
    cases = {
        "http://a.net/x": ("a.net", "/x", "net/", "block"), "https://net": ("net", "", None, "allow"),
        "http://WWW.Example.NET/en/1?x#y": ("www.example.net", "/en/1", "example.net/en/", "allow"),
        "http://notexample.net/en/1": ("notexample.net", "/en/1", "net/", "block"), "http://example.net/EN/": ("example.net", "/EN/", "net/", "block"),
        "http://m.example.com/de/": ("m.example.com", "/de/", "example.com/de/", "block"), "http://example.com/en/": ("example.com", "/en/", None, "allow"),
        "http://x.org/fr/#t": ("x.org", "/fr/", "org/fr/", "allow"), "http://x.org/fr": ("x.org", "/fr", None, "allow"),
        "http://www.spam-farm.example.com/en/": ("www.spam-farm.example.com", "/en/", None, "block"),
        "http://spam.farm.example.com/": ("spam.farm.example.com", "/", None, "allow"), "http://a.net:80/": ("a.net:80", "/", None, "allow"),
        "no scheme.net/": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"), "x://?net/": ("", "", None, "allow"),
        "http://adult-x.example.net/en/2": ("adult-x.example.net", "/en/2", "example.net/en/", "allow"), "a://b://c.net/": ("b:", "//c.net/", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "c") for i, u in enumerate(cases)] * 2 + [(None, "http://a.net/x", "c")], "page_id long, url string, rule string")
    got = url_rules.filter_urls(pages, url_rules.rules(spark)).collect()
    assert len(got) == 2 * len(cases) + 1
    for r in got:
        expected = list(cases.values())[r.page_id or 0]
        assert (r.host, r.path, r.rule, r.verdict) == expected, r
    assert url_rules.filter_urls(pages.limit(0), url_rules.rules(spark)).collect() == []
    none = url_rules.rules(spark).limit(0)
    assert {r.verdict for r in url_rules.filter_urls(pages, none).collect()} == {"allow"}


def test_preference_pairs(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 5, "assistant", "no"), (2, 6, "user", None),
             (3, 0, "user", "x"), (4, 0, "user", "x"), (5, 0, None, ""), (None, 0, "user", "x")]
    said = spark.createDataFrame([(*t, "c") for t in turns], "conv_id long, turn long, role string, text string, prompt string")
    pairs = spark.createDataFrame([("a", 1, 2), ("b", 3, 4), ("c", 5, 6)], "pair_id string, chosen long, rejected long")
    got = {r.pair_id: r for r in preference_chat.preference_format(said, pairs).collect()}
    a = got["a"]
    assert (a.status, a.n_prompt_turns, a.prompt) == ("pair", 1, "<|user|>\nhi<|end|>\n")
    assert a.chosen == "<|assistant|>\nyes<|end|>\n" and a.chosen_mask == "14:0,11:1"
    assert a.rejected == "<|assistant|>\nno<|end|>\n<|user|>\n<|end|>\n" and a.rejected_mask == "14:0,10:1,9:0,8:0"
    assert (got["b"].status, got["b"].chosen, got["b"].chosen_mask) == ("identical", "", "")
    assert (got["c"].status, got["c"].chosen, got["c"].prompt) == ("incomplete", "<|unknown|>\n<|end|>\n", "")
    for r in got.values():
        for text, runs in ((r.chosen, r.chosen_mask), (r.rejected, r.rejected_mask)):
            assert sum(int(x.split(":")[0]) for x in runs.split(",") if x) == len(text)
    assert preference_chat.preference_format(said.limit(0), pairs).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    found = con.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    expected = sorted(map(repr, found.fetchall()))
    assert sorted(repr(tuple(r[c] for c in columns)) for r in QUERIES[name](spark, SMOKE).collect()) == expected


# --- the pipeline


def plain_with_added(text):
    """The base spans and what the method adds on these tables: quoted tokens, and numbers of a card's length."""
    base = plain_spans(text)
    more = [(m.start(1), pii.SECRET, m.end(1)) for m in re.finditer(r'token = "([^"\s]{8,})"', text, re.IGNORECASE)]
    more += [(m.start(), pii.CARD, m.end()) for m in re.finditer(r"[0-9](?:[ -]?[0-9])+", text) if 12 <= sum(c.isdigit() for c in m[0]) <= 19]
    out = []
    for span in sorted(more):
        if all(span[2] <= s or e <= span[0] for s, _, e in [*base, *out]):
            out.append(span)
    return sorted(base + out)


def test_pipeline_equals_its_stages_by_brute_force(spark):
    got = sorted(map(tuple, corpus_pipeline.run(spark, SMOKE).collect()))
    scores = {r.doc_id: r.predicted for r in toxicity.op2_toxicity(spark, SMOKE).collect()}
    rows = [(r.doc_id, r.text) for r in table(spark, SMOKE, "documents").collect() if not scores[r.doc_id]]
    sets, kept, group = {d: ngram_join.exact_set(t or "") for d, t in rows}, [], {}
    for d, _ in sorted(rows):
        near = [o for o in group if sets[d] and 100 * len(sets[d] & sets[o]) >= 80 * len(sets[d] | sets[o])]
        group[d] = min([group[o] for o in near], default=d)
        for o in [o for o in group if group[o] in {group[n] for n in near}]:
            group[o] = group[d]
    kept = [(d, t) for d, t in rows if group[d] == d]
    items = [re.findall(r"[^\W_]+", r.text.lower()) for r in table(spark, SMOKE, "benchmark").collect()]
    grams = {tuple(w[i : i + 14]) for w in items for i in range(len(w) - 13)}
    encoder = byte_bpe.Encoder(byte_bpe.vocabulary_path())
    expected = []
    for d, t in kept:
        w = re.findall(r"[^\W_]+", t.lower())
        if not grams.intersection(zip(*(w[i:] for i in range(14)), strict=False)):
            text = pii.masked(t, plain_with_added(t))
            ids = encoder.encode(text)
            expected.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(expected)


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    df = table(spark, SMOKE, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, SMOKE).columns == df.columns, name
        assert stage(spark, df.limit(0), SMOKE).collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, df.limit(0), SMOKE).collect() == []


def test_pieces_kept_between_texts_stay_within_their_bound():
    """A worker is reused by other stages and keeps its pieces: texts of ever new words don't fill it."""
    import pyarrow as pa

    run = byte_bpe.encoded(byte_bpe.vocabulary_path())
    texts = [" ".join(str(1_000_000 + i * 9000 + j) for j in range(9000)) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(texts)], names=["_doc", "_text"])
    out = [row for found in run([batch]) for row in found.to_pylist()]
    encoder = byte_bpe._ENCODERS[byte_bpe.vocabulary_path()]
    assert len(encoder.known) <= 250_000  # of 360,000 distinct ones
    for row, text in list(zip(out, texts, strict=True))[::13]:
        ids = encoder.encode(text)
        assert row["n_tokens"] == len(ids) and row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_code_points_are_classified_without_all_of_them_in_memory(monkeypatch):
    import tracemalloc

    import regex

    monkeypatch.setattr(byte_bpe, "_CLASSES", [])
    tracemalloc.start()
    kinds = byte_bpe.classes()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10e6  # every worker does this at once when it begins: over 100 MB before
    for kind, pattern in ((byte_bpe.LETTER, r"\p{L}"), (byte_bpe.NUMBER, r"\p{N}"), (byte_bpe.SPACE, r"\s")):
        for at in (*range(0, 0xD800, 7), *range(0xE000, 0x110000, 11), 0xD7FF, 0xE000, 0x7FF, 0x800, 0x10FFFF):
            assert (kinds[at] == kind) == bool(regex.match(pattern, chr(at)))
