"""Every stage of the pipeline against brute force over the stage's own input."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from test_line_dedup import expected as lines_to_remove
from test_line_dedup import words
from test_models_and_packing import base_counts
from test_parity_join import linked, shingles
from test_row_operators import brute_force as contamination
from tokenizers import Tokenizer

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rnd = random.Random(12)
    vocabulary = [f"word{k}" for k in range(400)] + ["the", "of", "and", "Über"]
    item = " ".join(rnd.choice(vocabulary) for _ in range(20))
    texts = [None, "", "too short", "again and again " * 20]
    for _ in range(30):
        lines = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(3, 25))) for _ in range(rnd.randint(1, 5))]
        texts.append("\n".join(lines))
    for text in texts[10:20]:
        changed = (text or "").split(" ")
        # Every second word is new, so lines differ; a shared middle keeps a few alike.
        texts.append(" ".join(w if k % 9 else "new" + w for k, w in enumerate(changed)))
        texts.append(text)
    texts += [f"{item} {texts[25]} x", item.upper(), texts[12] + "\nmore words here at the end of it"]
    rnd.shuffle(texts)
    rows = [(i, t, rnd.choice(["en", "de"]), "s", len(t) if t else 0) for i, t in enumerate(texts)]
    return rows, [(1, item), (2, "unseen words only")]


def one_of_each(rows):
    sets = [(shingles(r.text), r) for r in rows]
    groups = []
    for s, r in sets:
        near = [g for g in groups if any(linked(s, t) for t, _ in g)]
        for g in near:
            groups.remove(g)
        groups.append([(s, r), *(x for g in near for x in g)])
    return sorted(min(r.doc_id for _, r in g) for g in groups)


def test_stages(spark, tmp_path):
    rows, items = corpus()
    folder = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    given, out = {}, {}
    for name, stage in corpus_pipeline.STAGES:
        given[name] = docs.collect()
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs.collect()
        if name != "packing":
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]

    ids = lambda name: sorted(r.doc_id for r in out[name])
    assert ids("quality_rules") == [r.doc_id for r in sorted(given["quality_rules"]) if not base_counts(r.text)[5]]

    ordered = sorted((r.doc_id, r.text) for r in given["line_dedup"])
    wanted = {}
    for (doc_id, text), gone in lines_to_remove(ordered).items():
        left = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone)
        if words(left) or not gone:
            wanted[doc_id] = left
    assert {r.doc_id: r.text for r in out["line_dedup"]} == wanted
    assert all(r.n_chars == len(r.text) for r in out["line_dedup"])
    assert len(wanted) < len(ordered)

    assert ids("near_duplicates") == one_of_each(given["near_duplicates"])

    texts = [r.text for r in given["decontamination"]]
    verdicts = contamination(texts, items)
    clean = [r.doc_id for k, r in enumerate(given["decontamination"]) if not verdicts[k][4]]
    assert ids("decontamination") == sorted(clean) and len(clean) < len(texts)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = Counter()
    for r in given["packing"]:
        own = np.array([*library.encode(r.text, add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(own), 2048)):
            part = own[at : at + 2048]
            pieces[r.doc_id, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out["packing"]) == pieces
