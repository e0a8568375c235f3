"""The filter audit against counting row by row."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

from llm_rows import documents
from pyspark.sql import functions as F

from gramledger.llm import filter_audit
from gramledger.llm.filter_audit import Relations, Rules

LABELS = "doc_id bigint, quality int, toxic int"


def plain_audit(rows):
    """rows: (part, good, toxic, failed letters)."""
    letters, out = "ABCDE", {}
    parts = {r[0] for r in rows}
    for part in parts:
        mine = [r for r in rows if r[0] == part]
        removed_by = Counter()
        for order in permutations(letters):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[3]]
                left = [r for r in left if f not in r[3]]
                removed_by[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in r[3] for r in mine) - len(gone), sum(r[3] == {f} for r in mine),
                    sum(r[1] for r in gone), sum(r[2] for r in gone)]
        for key, values in out.items():
            if key[0] == part:
                values.append(removed_by[key[1][key[2] - 1]])
    return out


def as_dict(df):
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    assert len({(r.part, r.filter_order, r.step) for r in rows}) == len(rows)
    return {(r.part, r.filter_order, r.step): [r[c] for c in columns] for r in rows}


def test_documents_equal_plain_counting(spark):
    draw = random.Random(2)
    docs = documents(spark).cache()
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1])) for i in range(0, 130, 2)] + [(4, 1, 1), (None, 1, 1)]
    rows, first = [], {}
    data = docs.select("doc_id", "text", "lang").collect()
    for r in data:
        if r.doc_id is not None:
            first[r.text or ""] = min(first.get(r.text or "", r.doc_id), r.doc_id)
    for r in data:
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = set()
        failed |= {"A"} if len(words) < 100 else set()
        failed |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        failed |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else set()
        failed |= {"D"} if re.search("[#$%&*|]", text) else set()
        failed |= {"E"} if r.doc_id is not None and first[text] < r.doc_id else set()
        mine = [x for x in labels if x[0] is not None and x[0] == r.doc_id]
        rows.append((r.lang or "", any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine), failed))
    got = as_dict(filter_audit.audit_documents(docs, spark.createDataFrame(labels, LABELS)))
    assert got == plain_audit(rows)
    docs.unpersist()


def test_relations_of_other_filters(spark):
    """Any set of failing-id tables can be audited, in several buckets and with hot parts."""
    draw = random.Random(3)
    rows = [(i, "hot" if i % 3 else f"p{i % 5}", draw.random() < 0.3, draw.random() < 0.1, {c for c in "ABCDE" if draw.random() < 0.25}) for i in range(600)]
    table = spark.createDataFrame([r[:4] for r in rows], "row bigint, part string, good boolean, toxic boolean")
    failing = {c: filter_audit.in_buckets(spark.createDataFrame([(r[0],) for r in rows if c in r[4]], "row bigint"), f"fails-{c}", 3) for c in "ABCDE"}
    tables = Relations(filter_audit.in_buckets(table, "rows", 3), failing, 3)
    assert as_dict(filter_audit.audit(tables)) == plain_audit([r[1:] for r in rows])


def test_joins_move_no_rows(spark):
    rows = filter_audit.in_buckets(spark.range(1000).select(F.col("id").alias("row")), "plan-rows", 4)
    fails = filter_audit.in_buckets(spark.range(0, 1000, 3).select(F.col("id").alias("row")), "plan-fails", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rows.join(fails, "row", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "LeftAnti" in plan and "Exchange" not in plan


def test_rules_at_their_limits():
    rules = Rules(least_words=3, distinct=80, capitals=10)
    assert rules.failed(b"") == (True, False, False, False)
    assert rules.failed(b"a b\x0bc") == (False, False, False, False)
    assert rules.failed(b"a a b c d") == (False, False, False, False)  # exactly 80 %
    assert rules.failed(b"a a b c") == (False, True, False, False)
    assert rules.failed("Aé日 bcdefg".encode()) == (True, False, False, False)  # 1 of 10 code points
    assert rules.failed("Aé日 bcdef".encode()) == (True, False, True, False)
    assert rules.failed(b"a b a a|c") == (False, True, False, True)


def test_empty_tables(spark, nothing):
    assert filter_audit.audit_documents(nothing, spark.createDataFrame([], LABELS)).collect() == []
