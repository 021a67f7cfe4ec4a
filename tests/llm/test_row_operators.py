"""Operators that judge each row by itself, against plain counterparts."""

import hashlib
import random
import re

import duckdb
import public_tokenizers
import pytest
import sentencepiece

from corpusloom.llm import decontaminate, html_text, licenses, token_counts
from corpusloom.llm.oracle import CONTAMINATION
from corpusloom.llm.queries import REGISTRY

TEXT = "doc_id long, text string, n_words string"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], TEXT)


# Decontamination


def brute_force(texts, items):
    out = {}
    for doc_id, text in enumerate(texts):
        words, hit, found = plain_words(text), set(), set()
        for item, content in items:
            own = plain_words(content)
            size = min(13, len(own))
            for at in range(len(own) - size + 1 if own else 0):
                for start in range(len(words) - size + 1):
                    if words[start : start + size] == own[at : at + size]:
                        hit.update(range(start, start + size))
                        found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id] = (len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words))
    return out


def contaminated_corpus():
    rnd = random.Random(4)
    vocabulary = ["a", "b", "The", "über", "Été", "x1"]
    items = [(n, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 13, 14, 20])))) for n in range(12)]
    items += [(50, items[0][1]), (51, None), (52, "?!")]
    texts = [None, "", "... !", "é"]
    for _ in range(40):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))]
        if rnd.random() < 0.7:
            words[0:0] = (rnd.choice(items)[1] or "").upper().replace("Ü", "ü").replace("É", "é").split(" ")
        texts.append(rnd.choice([" ", "\n", ", "]).join(words))
    return texts, items


@pytest.mark.parametrize("limit", [decontaminate.BLOCK_BYTES, 40])
def test_contamination_matches_brute_force(spark, monkeypatch, limit):
    """With one automaton, and with a benchmark cut into many blocks."""
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", (13, limit))
    texts, items = contaminated_corpus()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.judged(frame(spark, texts), benchmark).collect()
    result = {}
    for r in found:
        digest = hashlib.sha256(",".join(sorted(r["items"])).encode()).hexdigest()
        result[r.doc_id] = (r.n_words, r.n_hit, r.n_items, digest, r.contaminated)
        spans = [plain_words(texts[r.doc_id][s.start : s.end]) for s in r.chars]
        assert [len(w) for w in spans] == [h.end - h.start for h in r.hits]
    assert result == brute_force(texts, items)


def test_items_of_null_id_match_the_sql(spark, tmp_path):
    passage = " ".join(f"w{k}" for k in range(20))
    items = [(None, passage), (None, "four five six"), (1, "one two three"), (2, "Four five six"), (None, None)]
    texts = [f"x {passage} y", "one two three four five six", "one two three", "none", None, f"{passage} four five six"]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    wanted = con.execute(CONTAMINATION).fetchall()
    found = [tuple(r) for r in REGISTRY["op9_benchmark_decontamination"](spark, str(tmp_path)).collect()]
    assert sorted(found) == sorted(wanted)
    assert {r[0]: (r[2], r[3], r[5]) for r in found}[0] == (20, 1, True)
    docs, benchmark = (spark.read.parquet(f"{tmp_path}/{name}.parquet") for name in ("documents", "benchmark"))
    assert sorted(r.doc_id for r in decontaminate.clean(docs, benchmark).collect()) == [3, 4]
    assert [r["items"] for r in decontaminate.find(docs.where("doc_id = 0"), benchmark).collect()] == [[]]


def test_clean_keeps_rows_and_columns(spark):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    rows = [(1, "say one two three", "x"), (1, "nothing here", "y"), (None, "one two three", "z"), (2, None, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_key string")
    assert sorted(r.row_key for r in decontaminate.clean(docs, benchmark).collect()) == ["w", "y"]
    assert decontaminate.clean(docs, benchmark.where("1 = 0")).count() == 4
    assert decontaminate.judged(docs.where("1 = 0"), benchmark).collect() == []


# Licences


def test_base_places_match_brute_force(spark):
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    texts = [
        "The MIT-License, and the mit license.",
        "apache license mit license\nGENERAL PUBLIC LICENSE general public licenses",
        "",
        None,
        "permit license; mit\tlicense",
        "lesser general public license",
        "SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0",
    ]
    for r in licenses.licenses(frame(spark, texts)).collect():
        words = plain_words(texts[r.doc_id])
        places, labels = [], set()
        for phrase, label in phrases.items():
            own = phrase.split()
            for at in range(len(words)):
                if words[at : at + len(own)] == own:
                    places.append(at)
                    labels.add(label)
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(places), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == (min(places, default=None), max(places, default=None))
        assert set(labels) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert licenses.licenses(frame(spark, [])).collect() == []


@pytest.mark.parametrize(
    ("expression", "labels", "value"),
    [
        ("MIT", {"mit"}, 0.95),
        ("MIT OR GPL-3.0-only", {"mit", "gpl"}, 0.95),
        ("MIT AND GPL-3.0-only", {"mit", "gpl"}, 0.4),
        ("GPL-2.0-only WITH Classpath-exception-2.0", {"gpl"}, 0.6),
        ("MIT OR Apache-2.0 AND GPL-2.0", {"mit", "apache", "gpl"}, 0.95),
        ("(MIT OR Apache-2.0) AND GPL-2.0", {"mit", "apache", "gpl"}, 0.4),
        ("MIT is what we use", {"mit"}, 0.95),
        ("AND MIT (", {"mit"}, 0.95),
        ("MITRE-1.0", {"mitre-1.0"}, licenses.UNKNOWN),
        ("MIT-0 OR GPLv2", {"mit", "gpl"}, 0.95),
        ("Apache2", {"apache"}, 0.9),
        ("BSDish", {"bsdish"}, licenses.UNKNOWN),
    ],
)
def test_expressions(expression, labels, value):
    found, openness = licenses.evaluate(expression)
    assert found == labels and openness == pytest.approx(value)


# Token counts


def test_counts_and_prefixes_match_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    model = token_counts.piece_model(public_tokenizers.path(token_counts.MODEL))
    rnd = random.Random(2)
    letters = [*"abcthe   \n\n\t.,<s>éß▁日🙂019\x00 '", "the", "ing", "</s>", "    ", "\r"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 25))) for _ in range(300)]
    for text in texts:
        wanted = [len(library.encode(text[:k])) for k in range(len(text) + 1)]
        assert model.count(text) == wanted[-1] and model.table(text) == wanted
        for limit in (0, 1, 4):
            assert model.fit(text, limit) == max(k for k, n in enumerate(wanted) if n <= limit)
    texts = [*texts[:20], None, "word " * 6000]
    rows = token_counts.count_tokens(frame(spark, texts)).collect()
    for r in rows:
        text = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(library.encode(text)))
        assert r.over_limit == (r.n_tokens > 4096)
    assert rows[-1].over_limit and len(library.encode(texts[-1][: rows[-1].fit_chars])) <= 4096
    tables = {r.doc_id: r.counts for r in token_counts.prefix_tables(frame(spark, ["ab c", None])).collect()}
    assert tables == {0: model.table("ab c"), 1: [0]}


# Main text


def test_main_text(spark):
    article = "<article><h1>A &amp; B</h1><p>One\n two<br>three.<p>Fin</article>"
    pages = [
        (1, "u", f"<nav><a href='/'>Home</a></nav><div class='ad'>Buy now!</div>{article}<footer>(c)</footer>", "x"),
        (2, None, None, "x"),
        (3, "u", "", "x"),
        (4, "u", "<article><p>Cut off in the mid</p><p>Last wor", "x"),
        (5, "u", "<article><p>Tag cut</p><p cla", "x"),
        (6, "u", "<script>var t='<p>no</p>';</script><article><p>Yes.</p><ul class=comments><li>me too</ul></article>", "x"),
        (7, "u", "<article><p>1 < 2 &lt; 3</p><!-- <p>no</p> --><p>" + "long " * 50_000 + "</p></article>", "x"),
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    found = {r.page_id: r for r in html_text.main_text(table).collect()}
    assert found[1].text == "A & B\nOne two three.\nFin" and found[1].n_chars == len(found[1].text)
    assert found[2].text == "" and found[2].url is None and found[3].text == ""
    assert found[4].text == "Cut off in the mid\nLast wor" and found[5].text == "Tag cut"
    assert found[6].text == "Yes." and found[7].n_chars == len("1 < 2 < 3\n") + 5 * 50_000 - 1
    assert html_text.main_text(table.where("1 = 0")).collect() == []


@pytest.mark.parametrize(
    "html",
    [
        "<body><script>for(i=0;i<n;i++){f()}</script><p>Main text.</p></body>",
        "<body><script>var a='<!--', b=\"<p\";</script><p>Main text.</p></body>",
        "<head><script>if(a<b){c='<!--'}</SCRIPT ><title>a <b</title><style>a{b:'<!--'}</style></head><p>Main text.",
        "<head><meta charset=utf-8><title>No end of head</title><link href=x><p>Main text.</p>",
        "<div><textarea><p>no <!-- </textarea><p>Main text.</p></div>",
        "<div><title>no end<p>Main text.</p></div>",
        "<div><button>no</div><p>Main text.</p><button>no</button>",
        "<div><p><select><option>no</p></div><p>Main text.</p>",
        "<div><select><option>no<option>no<p>Main text.</p><select><option>no</select></div>",
        "<body><svg><path d='M0'><p>Main text.</p><svg><path></svg></body>",
        "<body><math><mi>x<p>Main text.</p></body>",
        "<body><svg><title>no</title><g><svg><text>no</text></svg><text>no</text></g></svg><p>Main text.</p></body>",
        "<body><button>no<p>Main text.</p></body>",
        "<body><object><object>no</object>no</object><p>Main text.</p><script>cut off <p>no",
        "<body><button>no<button>no</button><p>Main text.</p></body>",
    ],
)
def test_silent_elements_end(html):
    assert [b[0] for b in html_text.blocks(html)] == ["Main text."]


def test_page_with_minified_script(spark):
    html = "<article><script>for(i=0;i<n;i++){f()}</script><h1>Wool</h1><p>Prices fell on Monday.</p></article>"
    table = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    assert html_text.main_text(table).first().text == "Wool\nPrices fell on Monday."


def test_names_of_wrappers_do_not_frame(spark):
    text = "<h1>Wool</h1><p>Prices fell on Monday.</p><p>Yes.</p>"
    pages = [
        f"<body class='has-sidebar'><article>{text}</article></body>",
        f"<body class='sidebar'><article>{text}</article></body>",
        f"<body><div class='content no-banner'>{text}</div></body>",
        f"<body><main class='with-header'>{text}</main></body>",
        f"<body><main class='header'>{text}</main></body>",
        f"<body><article class='post tags-news'>{text}</article></body>",
        f"<body><div class='sidebar'><article>{text}</article></div></body>",
        f"<body><form><main>{text}</main></form></body>",
    ]
    table = spark.createDataFrame([(i, "u", x) for i, x in enumerate(pages)], "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_text.main_text(table).collect()}
    assert found == dict.fromkeys(range(len(pages)), "Wool\nPrices fell on Monday.\nYes.")


@pytest.mark.parametrize(
    ("html", "frame"),
    [
        ("<div class='main-nav'>x</div>", 1),
        ("<div class='ad-300x250'>x</div>", 1),
        ("<div id='comment-list'><article class='comment-body'>x</article></div>", 1),
        ("<article><div class='comments'><article>x</article></div></article>", 1),
        ("<aside><article>x</article></aside>", 1),
        ("<article><div class='post-header'>x</div></article>", 0),
        ("<div class='tags-news'>x</div>", 0),
        ("<div class='content-sidebar-wrap'>x</div>", 0),
    ],
)
def test_frame_names(html, frame):
    assert [b[4] for b in html_text.blocks(html)] == [frame]


@pytest.mark.parametrize(
    "marked",
    [
        "<p class='advert'>Buy a kettle now and get one free of charge.</p>",
        "<ul><li class='ad'>Buy a kettle now</li></ul>",
        "<span class='ad'>Buy a kettle now</span>",
        "<p class='cookie-notice'>We use cookies to make this site better for all.</p>",
        "<ul><li class='ad'><p>Buy</p><p>a kettle</p></ul>",
        "<p class='advert'>Buy a kettle now",
        "<span class='ad'>Buy <b>a</b> kettle <span>now</span></span>",
        "<span class='ad'>Buy a kettle now",
        "<dl><dt class='promo'>Kettle<dd class='promo'>Half price</dl>",
        "<table><tr class='sponsored'><td>Buy</td></tr></table>",
    ],
)
def test_adverts_and_notices_inside_the_article(spark, marked):
    html = f"<body><article><h1>Wool</h1><p>Prices fell on Monday.</p>{marked}<p>Yes, they did.</p></article></body>"
    table = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    assert html_text.main_text(table).first().text == "Wool\nPrices fell on Monday.\nYes, they did."


def test_lines_stay_whole_around_what_is_left_out(spark):
    html = (
        "<article><p>One <span class='ad'>Buy</span>two <a class='popup' href='#'>three</a>.<ul><li>a<li class='note'>b"
        "<ul><li>c</ul><li>d</ul><p class='text'>End <em class='highlight'>here</em></article>"
    )
    table = spark.createDataFrame([(1, "u", html)] * 2, "page_id long, url string, html string")
    assert [r.text for r in html_text.main_text(table).collect()] == ["One two three.\na\nb\nc\nd\nEnd here"] * 2


def test_long_page_without_article():
    """Many blocks and end tags of nothing take time in proportion."""
    html = "</section></ul>".join(f"<div><p>Line {k} of a long page.</p>" for k in range(20_000))
    assert len(html_text.blocks(html)) == 20_000


def test_labelled_pages_are_learned(spark):
    table = spark.createDataFrame(
        [(n, "", html) for n, (html, _) in enumerate(html_text.PAGES)], "page_id long, url string, html string"
    )
    found = {r.page_id: r.text for r in html_text.main_text(table).collect()}
    wrong = sum(found[n] != "\n".join(main) for n, (_, main) in enumerate(html_text.PAGES))
    assert wrong <= 1


def test_whole_counts_come_from_the_recursion(monkeypatch):
    """Each distinct part is solved by the recursion once; the library only checks it."""
    path = public_tokenizers.path(token_counts.MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    model, solved = token_counts.PieceModel(path), []
    real = model.prefixes
    monkeypatch.setattr(model, "prefixes", lambda part: (solved.append(part), real(part))[1])
    text = "One two one two\n<s> 日本語の文章です😀 " + "long" * 500 + "日本" * 300 + "  two\n\none"
    assert model.count(text) == len(library.encode(text)) and model.count("") == 0
    assert {"▁One", "▁two", "▁one", "▁<s>"[1:], "one"} <= set(solved) and len(solved) == len(set(solved))
    for part in solved:
        expected = len(library.encode(part[1:])) if part[0] == "▁" else len(library.encode("\n" + part)) - len(library.encode("\n"))
        assert real(part)[-1] == expected, part[:40]
