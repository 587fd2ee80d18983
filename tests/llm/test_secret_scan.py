import hashlib
import re

import pytest

from trendspark.llm import secret_scan as S

from .helpers import frame, odd_rows, words


def sha(i):
    return hashlib.sha1(str(i).encode()).hexdigest()


def texts():
    rows = [(i, f'{words(30, i)} token = "{sha(i)}" {words(20, 50 + i)}') for i in range(10)]
    rows += [(20 + i, f"{words(30, i)} commit {sha(i)} {words(5, i)}") for i in range(10)]
    rows += [(40, "see https://example.org/static/assets/image/library/main.js now"), (41, "rule ------------------------------ end"),
             (42, "call get_default_user_config_value_by_name(x)"), (43, f'a token = "{sha(1)}" b TOKEN = "{sha(2).upper()}"!! c')]
    return rows


@pytest.fixture(scope="module")
def findings(spark):
    return S.labelled_findings(spark)


def test_secrets_are_found_and_false_positives_removed(spark, findings):
    rows = texts() + [(100 + k, t) for k, (_, t) in enumerate(odd_rows())]
    out = S.find_secrets(frame(spark, rows, clash=True), findings).collect()
    by_id = dict(rows)
    expected = {(i, m.start(1)) for i, t in rows if t and i < 20 or i == 43 for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t)}
    assert {(r.doc_id, r.start) for r in out} == expected
    for r in out:
        secret = by_id[r.doc_id][r.start:r.start + r.length]
        assert hashlib.sha256(secret.encode()).hexdigest() == r.secret_sha256
    assert sorted((r.finding, r.start) for r in out if r.doc_id == 43)[0][0] == 0


def test_an_assigned_value_is_found_without_its_name(spark, findings):
    long = hashlib.sha256(b"a").hexdigest()
    values = [("SECRET_KEY=", long), ("export GH_TOKEN=", "ghp_" + "aB3dE6gH9jK2mN5pQ8sT1vW4yZ7bC0eF3hJ6"), ("export ACCOUNT_SERVICE_SECRET_KEY=", sha(7)),
              ("client_secret=", "q3VtZ8xK1nB6yR4wT9pL2sDfG7hJ0cAe==")]
    rows = [(i, f"{words(12, 70 + i)}\n{name}{value}\n{words(9, 80 + i)}") for i, (name, value) in enumerate(values)]
    out = S.find_secrets(frame(spark, rows), findings).collect()
    expected = [(i, rows[i][1].index(value), len(value), hashlib.sha256(value.encode()).hexdigest()) for i, (_, value) in enumerate(values)]
    assert sorted((r.doc_id, r.start, r.length, r.secret_sha256) for r in out) == expected
    clean = S.redact_secrets(frame(spark, rows), findings).collect()
    assert {r.doc_id: r.text for r in clean} == {i: rows[i][1].replace(value, "<secret>") for i, (_, value) in enumerate(values)}


def test_redaction_keeps_everything_else(spark, findings):
    rows = texts() + [(None, None), (51, ""), (51, "")]
    df = frame(spark, rows, clash=True)
    out = S.redact_secrets(df, findings)
    assert out.columns == df.columns
    got = [(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()]
    expected = [(i, t and (re.sub(r'(?i)(token = ")[0-9a-f]{40}"', r'\1<secret>"', t))) for i, t in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_the_plan_has_no_python(spark, findings):
    plan = S.find_secrets(frame(spark, texts()), findings)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty_table(spark, findings):
    assert S.find_secrets(frame(spark, []), findings).count() == 0
    assert S.redact_secrets(frame(spark, []), findings).count() == 0


def test_forest_on_other_labelled_findings(spark):
    """Fitted on half of the findings, tested on the other half."""
    from pyspark.sql import functions as F
    found = S.labelled_findings(spark, 3000).withColumn("test", F.xxhash64("candidate") % 2 == 0)
    forest = S.train_forest(found.where("not test").drop("test"))
    votes = " + ".join(forest)
    scored = found.where("test").select("label", F.expr(S.feature_sql("candidate", "before", "after")).alias("f")).select(
        "label", F.expr(f"({votes}) / {len(forest)}D").alias("score"))
    right = scored.where((F.col("score") >= 0.5) == (F.col("label") == 1)).count() / scored.count()
    assert right >= 0.97
