"""The filter audit against a plain evaluation of every order."""

import random
import re
from itertools import permutations

from corpusloom.llm import filter_audit
from corpusloom.sources.workdir import fresh_dir

SCHEMA = "doc_id long, text string, lang string, mask string, part string"
LABELS = "doc_id long, quality int, toxic int, part string"


def fails(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    found = "A" if len(words) < 100 else ""
    found += "B" if 100 * len(set(words)) < 80 * len(words) else ""
    found += "C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""
    return found + ("D" if re.search("[#$%&*|]", text) else "")


def expected(rows, labels):
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    docs = []
    for doc_id, text, lang in rows:
        again = doc_id is not None and doc_id > least[text or ""]
        docs.append((lang or "", fails(text or "") + ("E" if again else ""), doc_id in good, doc_id in toxic))
    found = {}
    removed_in_any = {}
    for part in {d[0] for d in docs}:
        own = [d[1:] for d in docs if d[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = list(own)
            for step, f in enumerate(order, 1):
                out = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                removed_in_any[part, f] = removed_in_any.get((part, f), 0) + len(out)
                failing = sum(f in d[0] for d in own)
                found[part, order, step] = [
                    len(left), len(out), failing - len(out), sum(d[0] == f for d in own),
                    sum(d[1] for d in out), sum(d[2] for d in out),
                ]
    return sorted((*k, *v, removed_in_any[k[0], k[1][k[2] - 1]]) for k, v in found.items())


def corpus(seed, n):
    rnd = random.Random(seed)
    pool = ["", "short", "A B C D", "many # marks | here", "Loud " * 120, " ".join(f"w{k}" for k in range(130))]
    for _ in range(15):
        words = [f"w{rnd.randrange(rnd.choice([20, 900]))}" for _ in range(rnd.choice([50, 100, 140]))]
        words = [w.upper() if rnd.random() < rnd.choice([0, 0.4]) else w for w in words]
        pool.append(rnd.choice([" ", "\n", "\t \x0b"]).join(words) + rnd.choice(["", " $", "\r"]))
    rows = [(doc_id, rnd.choice([*pool, None]), rnd.choice(["en", "en", "de", "", None])) for doc_id in rnd.sample(range(5 * n), n)]
    # A third of all rows share one text; some rows stand twice, some have no id.
    rows += [(10 * n + k, "the hot text", "en") for k in range(n // 2)]
    rows += rnd.sample(rows, 10) + [(None, "the hot text", "en"), (None, "short", "xx")]
    rnd.shuffle(rows)
    labels = [(rnd.choice(rows)[0], rnd.choice([0, 1, None]), rnd.choice([0, 1])) for _ in range(n // 2)]
    return rows, labels


def audited(spark, rows, labels, files, base=None, batches=None):
    folder = fresh_dir(spark, "audit-input")
    for k in range(files):
        part = [(d, t, lang, "m", "p") for d, t, lang in rows[k::files]]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/documents.parquet")
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = filter_audit.document_files(spark, f"{folder}/documents.parquet", schema, batches or files)
    said = spark.createDataFrame([(*r, "x") for r in labels], LABELS)
    return sorted(tuple(r) for r in filter_audit.audit(stream, said, base).collect())


def test_report_against_plain_evaluation(spark):
    rows, labels = corpus(5, 90)
    assert audited(spark, rows, labels, 5) == expected(rows, labels)


def test_smaller_ids_in_later_batches_retract(spark):
    # Ids fall from file to file, so every batch takes over all texts.
    rows = [(100 * (9 - k) + i, f"text {i % 3}", "en" if (k + i) % 2 else "de") for k in range(3) for i in range(9)]
    base = fresh_dir(spark, "audit-base")
    labels = [(rows[-1][0], 1, 1)]
    folder_rows = [rows[9 * (i % 3) + i // 3] for i in range(27)]
    assert audited(spark, folder_rows, labels, 3, base) == expected(rows, labels)
    changes = spark.read.parquet(f"{base}/changes")
    assert changes.where("n < 0").count() > 0
    assert changes.select("_batch").distinct().count() == 3


def test_a_batch_taken_twice_changes_nothing(spark):
    rows, labels = corpus(8, 40)
    halves = [spark.createDataFrame([(*r, "m", "p") for r in rows[k::2]], SCHEMA) for k in range(2)]
    said = spark.createDataFrame([(*r, "x") for r in labels], LABELS)
    base = fresh_dir(spark, "audit-twice")
    for number in (0, 1, 1):
        filter_audit.take_batch(filter_audit.marked(halves[number], said), number, base)
    counts = spark.read.parquet(f"{base}/changes").groupBy("part", "mask", "good", "toxic").sum("n")
    found = filter_audit.report(counts.withColumnRenamed("sum(n)", "n"))
    assert sorted(tuple(r) for r in found.collect()) == expected(rows, labels)


def test_empty_table_and_single_file(spark):
    assert audited(spark, [], [], 1) == []
    folder = fresh_dir(spark, "audit-one")
    rows = [(1, "x" * 200_000, "en"), (2, "x" * 200_000, "de")]
    frame = spark.createDataFrame([(*r, "m", "p") for r in rows], SCHEMA)
    frame.coalesce(1).write.parquet(folder)
    file = frame.sparkSession.read.parquet(folder).inputFiles()[0]
    stream = filter_audit.document_files(spark, file, frame.schema)
    found = filter_audit.audit(stream, spark.createDataFrame([], LABELS))
    assert sorted(tuple(r) for r in found.collect()) == expected(rows, [])
