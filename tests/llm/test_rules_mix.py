"""Quality rules and source mixing against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vidpulse.llm import mix_budget, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_rules(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": len(w) < 20 or 100 * len(covered) > 30 * len(w)}


def check_rules(df):
    rows = [r.text for r in df.collect()]
    got = quality_rules.assess(df).collect()
    want = sorted(str((t, *brute_rules(t).values())) for t in rows)
    assert sorted(str((r["row"]["text"], *(r[k] for k in brute_rules("")))) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_rules_documents(documents):
    check_rules(documents)


def test_rules_edge_cases(edge_docs):
    check_rules(edge_docs)
    assert quality_rules.passing(edge_docs).columns == edge_docs.columns


def test_rules_repeated_windows(spark):
    texts = ["a b c d e f g h " * 3, "a b c d e f g h i a b c d e f g h", "x " * 30, " ".join(f"w{k}" for k in range(40)),
             "p q r s t u v w " + " ".join(map(str, range(30))) + " p q r s t u v w", "a\na\n \n \nb\na", "é ü # | é"]
    check_rules(spark.createDataFrame([(t,) for t in texts], "text string"))


def test_rules_nothing(no_docs):
    assert quality_rules.passing(no_docs).count() == 0


def test_rules_plan_has_no_user_function(documents):
    plan = quality_rules.assess(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_rules_keep_clean_and_drop_junk(documents, spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = {r["row"]["doc_id"]: (r.kept, r.base_failed) for r in quality_rules.assess(docs).collect()}
    clean = [kept[d] for d, q in labels.items() if q == 1 and not kept[d][1]]
    junk = [kept[d][0] for d, q in labels.items() if q == 0]
    assert all(k for k, _ in clean)
    assert sum(junk) <= 0.05 * len(junk)


def brute_targets(sizes, ratio=1.5, copies=2):
    keys = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(keys)}
    target, free, left = {}, set(keys), ratio * sum(sizes.values())
    while free:
        total = sum(weight[k] for k in free)
        over = {k for k in free if left * weight[k] / total > copies * sizes[k]}
        if not over:
            return target | {k: left * weight[k] / total for k in free}
        for k in over:
            target[k] = copies * sizes[k]
        left -= sum(target[k] for k in over)
        free -= over
    return target


def check_mix(df):
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    got = mix_budget.plan_mix(df).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    targets = brute_targets(sizes)
    taken, longest = defaultdict(int), defaultdict(int)
    for r in got:
        s = None if r.skey == "1" else r.skey[1:]
        assert r.source_size == sizes[s] and r.target == pytest.approx(targets[s])
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 2
        taken[s] += r.taken
        longest[s] = max(longest[s], r["size"])
    for s, t in targets.items():
        assert abs(taken[s] - t) <= max(1, longest[s])
    again = mix_budget.plan_mix(df).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    out = mix_budget.mixed(df)
    assert out.columns == df.columns and out.count() == sum(r.copies for r in got)
    assert sum(len(WORD.findall(r.text or "")) for r in out.collect()) == sum(taken.values())


def test_mix_documents(documents):
    check_mix(documents)


def test_mix_edge_cases(edge_docs):
    check_mix(edge_docs)


def test_targets_of_many_sources(spark):
    """Sources as many as host names: the targets are right and no window has all of them in one task."""
    sizes = {f"host{k * 7919 % 5000}.example": (k * 104729) % 997 for k in range(5000)}
    hist = spark.createDataFrame([("0" + s, n, 1) for s, n in sizes.items()], "skey string, size long, n long")
    out = mix_budget._targets(hist, 1.5, 2)
    want = brute_targets(sizes)
    got = {r.skey[1:]: r for r in out.collect()}
    assert set(got) == set(sizes)
    assert all(r.source_size == sizes[s] and r.target == pytest.approx(want[s]) for s, r in got.items())
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_mix_nothing(no_docs):
    assert mix_budget.plan_mix(no_docs).count() == 0
    assert mix_budget.mixed(no_docs).count() == 0


def test_mix_of_a_row_repeated_for_a_third_of_the_table(spark):
    """Copies of one row share a draw; they count as one row with a number."""
    rows = [(7, "same words here", "a")] * 2500 + [(k, " ".join("w" * (k % 9 + 1)), "ab"[k % 2]) for k in range(3000)] + [(None, "no id", "b")] * 1200
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check_mix(df)
    got = [r.copies for r in mix_budget.plan_mix(df).where("id = 7 and skey = '0a'").collect()]
    assert len(got) >= 2500 and max(got) - min(got) <= 1


def test_only_the_cut_is_ranked(spark, documents):
    """Rows outside the buckets of the cut meet no window."""
    plan = mix_budget.plan_mix(documents)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    union = text[text.index("Union"):].split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    branches, top = [], depth(union[1])
    for line in union[1:]:
        if depth(line) == top:
            branches.append([])
        branches[-1].append(line)
    whole, at_cut = ("\n".join(b) for b in branches)
    assert "Window" not in whole and "Window" in at_cut
    assert "Filter" in whole and "cut" in whole and "cut" in at_cut


def test_mix_hot_length(spark):
    """A third of all rows of one source and length: the cut is ranked exactly."""
    texts = ["a b c d e"] * 1000 + [" ".join("w" * k) for k in range(1, 60) for _ in range(20)]
    df = spark.createDataFrame([(i, t, "hot" if i % 4 else "cold") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = mix_budget.plan_mix(df).collect()
    for s in ("hot", "cold"):
        own = [r for r in got if r.skey == "0" + s]
        assert sum(r.taken for r in own) == round(own[0].target)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 5), min_size=1, max_size=8), st.integers(0, 300))
def test_knapsack_is_exact(hist, budget):
    sizes, counts = np.array(list(hist)), np.array(list(hist.values()))
    reach = {0}
    for size, count in hist.items():
        reach = {s + size * k for s in reach for k in range(count + 1)}
    take = mix_budget.bounded_knapsack(sizes, counts, budget)
    assert (take >= 0).all() and (take <= counts).all()
    assert (take * sizes).sum() == max(s for s in reach if s <= budget)


def test_fit_of_large_source_stays_near():
    rng = np.random.default_rng(3)
    sizes = np.unique(rng.integers(1, 20_000, 5000))
    counts = rng.integers(1, 2000, len(sizes))
    total = int((sizes * counts).sum())
    for share in (0.1, 0.73, 1.4, 2.0):
        base, extra = mix_budget.fit_source(sizes, counts, round(total * share))
        assert (extra <= counts).all() and abs(base * total + int((extra * sizes).sum()) - round(total * share)) <= 1
