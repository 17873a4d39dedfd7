import math
import random

import pytest
from data import entries, entry
from pyspark.sql import functions as F

from mendlake.functions import training as M
from mendlake.operators import dataset, evaluate as E
from mendlake.schema import GROUPS

# Small samples of code with one category each, as a user would label them.
SAMPLES = [
    ("char* p = new char[9];\nuse(p);\n", "char* p = new char[9];\nuse(p);\ndelete[] p;", "resource_leak"),
    ("int a[3];\na[3] = 1;", "int a[4];\na[3] = 1;", "invalid_access"),
    ("int n;\nreturn n;", "int n = 0;\nreturn n;", "uninitialized"),
    ("if (n = 2) go();", "if (n == 2) go();", "logic_error"),
    ("m.lock();\nif (x) return;\nm.unlock();", "std::lock_guard g(m);\nif (x) return;", "concurrency"),
]


def sample_entries(spark, copies=20):
    return entries(spark, *[
        entry(n, before, after, minutes=n, **{flag: True})
        for n, (before, after, flag) in enumerate(SAMPLES * copies)
    ])


def test_active_label(spark):
    df = entries(
        spark, entry(1, invalid_access=True, memory_management=True), entry(2), entry(3, code_style=True),
        entry(4, class_design=True, security_portability=True),
    )
    got = [r[0] for r in df.orderBy("entry_id").select(M.active_label()).collect()]
    assert got == ["Memory Management", "Unknown", "Code Quality/Performance", "Security/Portability"]


def test_training_rows(spark):
    df = entries(
        spark, entry(1, "a", "b", logic_error=True), entry(2, "a", None, logic_error=True),
        entry(3, "a", "", logic_error=True), entry(4, "", "b", logic_error=True), entry(5, "a", "b"),
    )
    got = {int(r["sample_id"], 16): r["code_fixed"] for r in dataset.training_rows(df).collect()}
    assert got == {1: "b", 2: "a", 3: "a"}


def test_prompt(spark):
    df = spark.createDataFrame([("\n a {x} \t", " b　", "Logic Error")], "o string, f string, l string")
    o, f, label = F.col("o"), F.col("f"), F.col("l")
    train, infer = df.select(M.prompt(o, f, label), M.prompt(o, f)).collect()[0]
    want = M.PROMPT_HEAD + "a {x}" + M.PROMPT_MIDDLE + "b" + M.PROMPT_TAIL
    assert train == want + "Logic Error" and infer == want.rstrip()
    assert infer.endswith("### Response:") and train.count("```cpp") == 2


def answer(raw):
    """The category of an answer, step by step."""
    text = raw.strip().split("\n")[0].strip(".,!?;:").lower()
    by_title = {t.lower(): t for t in M.TITLES.values()}
    if text in by_title:
        return by_title[text]
    hits = [t for low, t in by_title.items() if low in text] or [t for w, t in M.KEYWORDS.items() if w in text]
    return hits[0] if hits else "Unknown"


def test_parse_prediction(evaluate):
    cases = [
        "Memory Management", "memory management.", "  Logic Error\nbecause of memory", "!?Invalid Access;:", "",
        "I say: Resource Leak, no Logic Error", "Logic Error or Memory Management", "a race", "thread leak", "leak of access",
        "uninit", "UNINITIALIZED value", "performance", "Security/Portability!", "portable", "concurrency", "\n\n", "...",
        " . Logic Error . ", "Code Quality", "quality\r\nmemory", "memory x",
    ]
    assert evaluate(M.parse_prediction, cases) == [answer(c) for c in cases]


def test_split_is_exact_per_label_and_disjoint(spark):
    rows = dataset.training_rows(sample_entries(spark))
    split = dataset.stratified_split(rows)
    assert split.count() == 100 and split.select("sample_id").distinct().count() == 100
    counts = {(r["split"], r["label"]): r["n_samples"] for r in dataset.label_distribution(split, "split").collect()}
    assert all(n == (4 if part == "test" else 16) for (part, _), n in counts.items()) and len(counts) == 10
    again = {(r["sample_id"], r["split"]) for r in dataset.stratified_split(rows.repartition(7)).collect()}
    assert again == {(r["sample_id"], r["split"]) for r in split.collect()}
    other = {(r["sample_id"], r["split"]) for r in dataset.stratified_split(rows, seed=1).collect()}
    assert other != again


def test_split_of_uneven_labels_with_any_number_of_buckets(spark):
    import hashlib

    rng = random.Random(5)
    titles = list(M.TITLES.values())[:4]
    rows = [(f"s{n}", rng.choice(titles[:1] * 6 + titles)) for n in range(503)]
    df = spark.createDataFrame(rows, "sample_id string, label string")
    n_test = math.ceil(0.2 * len(rows))
    want_counts = {r["label"]: r["n_test"] for r in dataset.split_quotas(df.groupBy("label").agg(F.count("*").alias("n"))).collect()}
    assert sum(want_counts.values()) == n_test
    for title, n in want_counts.items():
        assert abs(n - 0.2 * sum(1 for r in rows if r[1] == title)) <= 1
    want = set()
    for title in titles:
        ranked = sorted((hashlib.md5(f"42:{s}".encode()).hexdigest(), s) for s, t in rows if t == title)
        want |= {s for _, s in ranked[: want_counts[title]]}
    for buckets in (1, 4, 65536):
        split = dataset.stratified_split(df, buckets=buckets)
        assert {r["sample_id"] for r in split.filter("split = 'test'").collect()} == want


def test_split_without_test_rows(spark):
    df = spark.createDataFrame([("a", "Logic Error"), ("b", "Logic Error")], "sample_id string, label string")
    assert {r["split"] for r in dataset.stratified_split(df, test_size=0.0).collect()} == {"train"}


SCORED = [
    ("a", "a"), ("a", "a"), ("a", "b"), ("b", "a"), ("b", "b"), ("c", "x"), ("c", "c"), ("c", "c"), ("c", "a"),
]


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "true_label string, predicted_label string")


def test_accuracy_and_confusion(spark):
    df = scored(spark, SCORED)
    row = E.accuracy(df).collect()[0]
    assert (row["correct"], row["total"]) == (5, 9) and math.isclose(row["accuracy"], 500 / 9)
    matrix = {(r["true_label"], r["predicted_label"]): r["n"] for r in E.confusion_matrix(df, "abcx").collect()}
    with pytest.raises(Exception, match="label not listed: x"):
        E.confusion_matrix(df, "abc").collect()
    labels = "abcx"
    assert matrix == {(t, p): SCORED.count((t, p)) for t in labels for p in labels}
    assert E.accuracy(scored(spark, []).limit(0)).collect()[0]["accuracy"] == 0.0


def test_classification_report(spark):
    got = {r["label"]: r for r in E.classification_report(scored(spark, SCORED)).collect()}
    labels = "abcx"
    want = {}
    for x in labels:
        agreed = SCORED.count((x, x))
        actual, predicted = sum(t == x for t, _ in SCORED), sum(p == x for _, p in SCORED)
        p, r = (agreed / predicted if predicted else 0), (agreed / actual if actual else 0)
        want[x] = (p, r, 2 * p * r / (p + r) if p + r else 0, actual)
    for x in labels:
        assert all(math.isclose(g, w) for g, w in zip(list(got[x])[1:], want[x]))
    assert math.isclose(got["accuracy"]["f1_score"], 5 / 9) and got["accuracy"]["precision"] is None
    for i, column in enumerate(("precision", "recall", "f1_score")):
        assert math.isclose(got["macro avg"][column], sum(w[i] for w in want.values()) / 4)
        assert math.isclose(got["weighted avg"][column], sum(w[i] * w[3] for w in want.values()) / 9)
    assert got["macro avg"]["support"] == 9 and len(got) == 7
    both = {r["label"]: (r["actual"], r["predicted"]) for r in E.actual_vs_predicted(scored(spark, SCORED)).collect()}
    assert both == {"a": (3, 4), "b": (2, 2), "c": (4, 2), "x": (0, 1)}


def test_comparison(spark):
    def verdict(base, tuned, n=100):
        rows = lambda k: scored(spark, [("a", "a")] * k + [("a", "b")] * (n - k))
        return E.model_comparison(rows(base), rows(tuned)).collect()[0]

    row = verdict(40, 46)
    assert row["verdict"] == "effective" and math.isclose(row["relative_change"], 15.0) and row["correct_change"] == 6
    assert [verdict(*x)["verdict"] for x in ((40, 45), (40, 40), (40, 39))] == ["marginal", "no change", "degraded"]
    assert math.isclose(verdict(0, 50)["relative_change"], 50 / 0.01 * 100)
    per = {r["label"]: (r["baseline_accuracy"], r["tuned_accuracy"]) for r in E.per_category_accuracy(
        scored(spark, SCORED), scored(spark, [("a", "a"), ("b", "x"), ("c", "c")])).collect()}
    assert per == {"a": (2 / 3 * 100, 100.0), "b": (50.0, 0.0), "c": (50.0, 100.0)}


def test_score_joins_by_sample(spark):
    truth = spark.createDataFrame([(1, "Logic Error"), (2, "Concurrency")], "sample_id int, label string")
    raw = spark.createDataFrame([(2, "race"), (1, "memory"), (3, "logic")], "sample_id int, raw_prediction string")
    got = {r["sample_id"]: (r["true_label"], r["predicted_label"]) for r in E.parsed(E.score(truth, raw)).collect()}
    assert got == {1: ("Logic Error", "Memory Management"), 2: ("Concurrency", "Concurrency")}


def test_group_order_is_the_document_order():
    assert list(M.TITLES)[:7] == list(GROUPS[:7])
