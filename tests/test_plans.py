"""Plan shapes that the scale design relies on (checked on the physical plan text)."""

import re

import __spark_entry__ as E
from conftest import SF_SMALL

from revlens.plans.queries import QUERIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(p: str, column: str) -> list[str]:
    return [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", p)
            if column in [c.split("#")[0] for c in s.split(",")]]


def exchanges(p: str) -> list[tuple[str, str]]:
    """(exchange line, the line of its child) for every exchange in the plan."""
    lines = p.split("\n")
    return [(l.strip(), lines[i + 1].strip() if i + 1 < len(lines) else "")
            for i, l in enumerate(lines) if "Exchange" in l]


def test_scan_prunes_columns_and_top_k_is_bounded(spark):
    p = plan_of(E.queries()["top_words"](spark, SF_SMALL))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", p)
    assert [re.sub(r"#\d+", "", s) for s in scans] == ["text"]
    assert "TakeOrderedAndProject(limit=100" in p


def test_no_python_in_registered_queries(spark):
    for name, q in QUERIES.items():
        if name.startswith("svm_") or name.startswith("chain_"):
            continue  # they run for long while the plan is built
        p = plan_of(q(spark, SF_SMALL))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
            assert marker not in p, (name, marker)


def test_balancing_single_partition_step_is_bucket_counts_only(spark):
    p = plan_of(E.queries()["balanced_binary_drop4"](spark, SF_SMALL))
    singles = [(e, child) for e, child in exchanges(p) if "SinglePartition" in e]
    assert singles
    for _, child in singles:  # the running sum over <= 16**4 bucket counts
        assert ("_b#" in child and "_c#" in child or "partial_max(_whole" in child) and "document" not in child


def test_hashed_model_tables_are_broadcast(spark):
    p = plan_of(E.queries()["nb_predict"](spark, SF_SMALL))
    assert "BroadcastHashJoin [term" in p
    assert not any("hashpartitioning(term" in e and "tfidf" in c for e, c in exchanges(p))


def test_full_segmentation_candidates_are_never_shuffled(spark):
    p = plan_of(E.queries()["segment_full"](spark, SF_SMALL))
    shuffles = [(e, c) for e, c in exchanges(p) if "BroadcastExchange" not in e]
    # the only shuffle gathers the lexicon's prefixes; the documents are read once
    assert all("collect_set" in c for _, c in shuffles) and "BroadcastHashJoin [word" in p
    assert len(scans(p, "text")) == 1


def test_review_text_is_never_shuffled_for_sampling(spark):
    for name in ("balanced_binary_drop4", "balanced_multi", "balanced_binary_4neg", "distinct_reviews"):
        p = plan_of(E.queries()[name](spark, SF_SMALL))
        for e, child in exchanges(p):
            if "Broadcast" in e or "hashpartitioning(doc_id" in e:
                continue  # the review view's and the anti join by doc_id: left to the optimizer
            assert "document" not in child and "line" not in child.split("keys=")[0], (name, e, child)


def test_term_counts_need_no_shuffle(spark):
    assert exchanges(plan_of(E.queries()["term_counts"](spark, SF_SMALL))) == []
    assert scans(plan_of(E.queries()["tfidf"](spark, SF_SMALL)), "text") == []  # counts are read as written
