"""Secret scans with a random forest against false positives.

Candidates are long runs of the characters that keys are made of. Each is
described by its length, its character transitions, how much of it a
dictionary covers, whether it lies in a path, and its neighbouring words; a
random forest trained on labelled findings votes on it. The forest is written
out as a SQL expression, so scanning and redacting are expressions on the rows
of the documents table: no Python on the executors, no shuffle, and a text's
candidates never leave its row.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.llm.common import aliased

#: ``=`` belongs to a candidate only as padding at its end; elsewhere it parts a name from its value.
CANDIDATE = "[A-Za-z0-9+/_-]{20,}+(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
#: Characters before and after a candidate that count as its neighbourhood.
NEAR = 48
#: Words that code and placeholder texts are made of.
DICTIONARY = ("account address api app array assets base board build cache change class client code column common component config "
              "content context control count create custom data date default demo description detail dummy element error event example "
              "field file filter font format foo from function get global goes group handler header here home html http icon image "
              "index info input insert item java json key label last level library license line link list local lock main manager "
              "message method model module name node number object option order package page password path picture place placeholder "
              "plugin position process product property public query record replace request resource response result sample script "
              "search secret section select service session set setting source state static status string style switch system table "
              "target template test text theme this time title token tree type update user util value version view window with word "
              "www xml your").split()
SECRET_WORDS = "token|secret|key|passw|pwd|auth|bearer|credential|access|private|api"
OTHER_WORDS = "commit|sha|md5|checksum|hash|etag|digest|integrity|uuid|guid|revision|rev|version|number|order|id|image|build|crc|isbn"
FEATURES = ["length", "digits", "uppers", "letters", "symbols", "hexadecimal", "transitions", "distinct", "entropy", "covered", "vowels",
            "path", "slashes", "secret_word", "secret_near", "other_word", "assigned", "quoted"]


def feature_sql(c: str, before: str, after: str) -> str:
    """``named_struct`` of all features, of SQL expressions for the candidate and the texts around it."""
    words = "|".join(sorted(DICTIONARY, key=len, reverse=True))
    share = f"cast(length(regexp_replace({c}, '{{}}', '')) as double) / length({c})"
    kinds = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '[^A-Za-z0-9]', '-'), '[a-z]', 'a'), '[A-Z]', 'B'), '[0-9]', '0')"
    each = f"array_distinct(split({c}, ''))"
    times = f"(length({c}) - length(replace({c}, ch, '')))"
    low_before = f"lower({before})"
    parts = {
        "length": f"cast(length({c}) as double)",
        "digits": share.format("[^0-9]"),
        "uppers": share.format("[^A-Z]"),
        "letters": share.format("[^A-Za-z]"),
        "symbols": share.format("[A-Za-z0-9]"),
        "hexadecimal": f"cast({c} rlike '^([0-9a-f]+|[0-9A-F]+)$' as double)",
        "transitions": f"cast(length(regexp_replace({kinds}, '(.)\\\\1+', '$1')) - 1 as double) / length({c})",
        "distinct": f"cast(size({each}) as double) / length({c})",
        "entropy": f"aggregate(filter({each}, ch -> ch != ''), 0D, (total, ch) -> total - {times} / length({c}) * log2({times} / cast(length({c}) as double)))",
        "covered": f"1D - cast(length(regexp_replace(lower({c}), '{words}', '')) as double) / length({c})",
        "vowels": share.format("[^aeiouAEIOU]"),
        "path": f"cast({before} rlike '([/\\\\\\\\]|https?:[^ ]*)$' or {after} rlike '^[.][A-Za-z]{{1,5}}([^A-Za-z]|$)' as double)",
        "slashes": f"cast(length({c}) - length(replace({c}, '/', '')) as double)",
        "secret_word": f"cast({low_before} rlike '({SECRET_WORDS})[a-z_]{{0,8}}[^a-z]{{0,6}}$' as double)",
        "secret_near": f"cast({low_before} rlike '({SECRET_WORDS})' as double)",
        "other_word": f"cast({low_before} rlike '({OTHER_WORDS})[a-z0-9]{{0,6}}[^a-z]{{0,6}}$' as double)",
        "assigned": f"cast({before} rlike '[=:] ?[\"\\']?$' as double)",
        "quoted": f"cast({before} rlike '[\"\\']$' and {after} rlike '^[\"\\']' as double)",
    }
    return "named_struct(" + ", ".join(f"'{k}', {parts[k]}" for k in FEATURES) + ")"


def labelled_findings(spark: SparkSession, rows: int = 4000) -> DataFrame:
    """``(candidate, before, after, label)``: the default findings to learn from, made by rule with known labels.

    Keys of the usual shapes in assignments, headers and prefixes are secrets;
    hashes of commits and files, identifiers, words, placeholders, paths,
    rulers and long numbers are not. Pass findings of your own to
    ``train_forest`` instead where there are any.
    """
    base = "translate(base64(unhex(sha2(concat('b', id), 256))), '=+', 'xY')"
    letters = "translate(concat(md5(concat('w', id)), md5(concat('v', id))), '0123456789abcdef', 'aeiontrshldcmupg')"
    code = "array('token', 'user', 'config', 'value', 'default', 'service', 'handler', 'template', 'request', 'session', 'number', 'content')"

    def word(salt: int) -> str:
        return f"element_at({code}, 1 + cast(pmod(xxhash64(id, {salt}), 12) as int))"

    lead = "concat(substr(translate(md5(concat('l', id)), '0123456789abcdef', 'aeiontrshldcmupg'), 1, 5 + id % 9), if(id % 7 = 0, '\\n', ' '))"
    secret = [
        ("sha1(concat('s', id))", "'token = \"'", "'\"'"), ("upper(sha1(concat('s', id)))", "'TOKEN = \"'", "'\"!!'"),
        ("md5(concat('s', id))", "'api_key: '", "' '"), ("sha2(concat('s', id), 256)", "'SECRET_KEY='", "'\\n'"),
        (f"substr({base}, 1, 20 + id % 23)", "'password = \\''", "'\\''"), (f"concat('sk_live_', substr({base}, 1, 24))", "'use '", "' '"),
        (f"concat('ghp_', substr(translate({base}, '/', 'q'), 1, 36))", "'export GH_TOKEN='", "'\\n'"),
        (f"concat('AKIA', upper(substr(translate({base}, '/', 'q'), 1, 16)))", "'aws access key '", "' '"),
        (f"substr({base}, 1, 40)", "'Authorization: Bearer '", "'\\n'"), (f"substr({base}, 1, 32)", "'\"client_secret\": \"'", "'\",'"),
    ]
    other = [
        ("sha1(concat('s', id))", "'commit '", "'\\n'"), ("sha2(concat('s', id), 256)", "'sha256:'", "' '"), ("md5(concat('s', id))", "'ETag: \"'", "'\"'"),
        ("regexp_replace(md5(concat('s', id)), '^(.{8})(.{4})(.{4})(.{4})', '$1-$2-$3-$4-')", "'uuid '", "' '"),
        (f"concat_ws('_', {word(1)}, {word(2)}, {word(3)}, {word(4)})", "'call '", "'('"),
        (f"substr({letters}, 1, 20 + id % 20)", "'und '", "' '"), (f"substr({letters}, 1, 20 + id % 12)", "''", "'. '"),
        (f"upper(substr({letters}, 1, 20 + id % 12))", "'THE '", "'!! '"),
        (f"concat_ws('/', {word(1)}, {word(2)}, substr(md5(concat('s', id)), 1, 8), {word(3)})", "'https://www.example.org/'", "'.js '"),
        (f"concat_ws('-', 'your', {word(1)}, 'key', 'goes', 'here')", "'api_key = \"'", "'\"'"), ("repeat('x', 20 + id % 20)", "'token = \"'", "'\"'"),
        ("repeat(element_at(array('-', '=', '_', '0'), 1 + cast(id % 4 as int)), 20 + id % 40)", "'\\n'", "'\\n'"),
        ("translate(sha1(concat('n', id)), 'abcdef', '0123456')", "'order number '", "' '"), (f"concat({word(1)}, initcap({word(2)}), initcap({word(3)}), initcap({word(4)}))", "'key = '", "'.'"),
    ]

    def pick(of: list, column: int) -> str:
        return "case " + " ".join(f"when pmod(id div 2, {len(of)}) = {i} then {x[column]}" for i, x in enumerate(of)) + " end"

    found = spark.range(rows)
    made = [F.expr(f"if(id % 2 = 1, {pick(secret, i)}, {pick(other, i)})") for i in range(3)]
    return found.select(made[0].alias("candidate"), F.concat(F.expr(lead), made[1]).alias("before"), made[2].alias("after"),
                        (F.col("id") % 2).cast("double").alias("label"))


def _tree_sql(text: str, row: str) -> str:
    """A decision tree's printed rules as a nested SQL condition that gives 1 for a secret."""
    lines = [line.strip() for line in text.splitlines()[1:] if line.strip()]
    rule = re.compile(r"If \(feature (\d+) <= (\S+)\)")

    def walk(at: int) -> tuple[str, int]:
        if lines[at].startswith("Predict"):
            return str(int(float(lines[at].rpartition(" ")[2]))), at + 1
        feature, bound = rule.match(lines[at]).groups()
        yes, at = walk(at + 1)
        no, at = walk(at + 1)  # the line between is the Else
        return f"if({row}.{FEATURES[int(feature)]} <= {float(bound)!r}D, {yes}, {no})", at

    return walk(0)[0]


def train_forest(findings: DataFrame, trees: int = 25, depth: int = 6, seed: int = 17) -> list[str]:
    """Fits a random forest to labelled findings; each tree as a SQL condition on the feature struct ``f``."""
    described = findings.select("label", F.expr(feature_sql("candidate", "before", "after")).alias("f")).select("label", "f.*")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(described).select("label", "features")
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(rows)
    return [_tree_sql(tree.toDebugString, "f") for tree in model.trees]


def _examined(docs: DataFrame, forest: list[str], text_col: str) -> DataFrame:
    """``docs`` with ``_between`` (the text around the candidates) and ``_found``: each candidate with its share of the votes."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    parted = docs.withColumns({"_found": F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), "_between": F.split(text, CANDIDATE, -1)})
    # the text before goes back over earlier candidates, as a long name before its value is one
    earlier = "array_join(transform(sequence(greatest(i - 3, 0), i), j -> concat(_between[j], if(j < i, _found[j], ''))), '')"
    around = f"named_struct('c', x, 'before', right({earlier}, {NEAR}), 'after', left(_between[i + 1], {NEAR}))"
    described = f"transform(transform(_found, (x, i) -> {around}), x -> named_struct('c', x.c, 'f', {feature_sql('x.c', 'x.before', 'x.after')}))"
    votes = " + ".join(t.replace("f.", "x.f.") for t in forest)
    return parted.withColumn("_found", F.expr(f"transform({described}, x -> named_struct('c', x.c, 'score', cast({votes} as double) / {len(forest)}))"))


def find_secrets(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, finding, start, length, secret_sha256, score)``: one row for each candidate that the forest takes for a secret.

    ``finding`` counts the secrets of a row from 0, ``start`` is in characters.
    Null and empty texts have none; rows with a null or repeated id are
    scanned like any other.
    """
    forest = train_forest(findings if findings is not None else labelled_findings(docs.sparkSession))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where(F.col("text").rlike(CANDIDATE))
    at = ("aggregate(slice(_between, 1, i + 1), 0L, (s, x) -> s + length(x)) + aggregate(slice(_found, 1, i), 0L, (s, x) -> s + length(x.c))")
    listed = _examined(rows, forest, "text").select("doc_id", F.expr(
        f"filter(transform(_found, (y, i) -> named_struct('score', y.score, 'c', y.c, 'start', if(y.score >= {threshold}, {at}, 0L))), "
        f"y -> y.score >= {threshold})").alias("secrets"))
    found = listed.select("doc_id", F.posexplode("secrets").alias("finding", "s"))
    return found.select("doc_id", "finding", F.col("s.start").alias("start"), F.length("s.c").alias("length"),
                        F.sha2("s.c", 256).alias("secret_sha256"), F.col("s.score").alias("score"))


def redacted_text(text_col: str, mark: str, threshold: float) -> Column:
    """The text put together again with ``mark`` in the place of each secret."""
    pieces = (f"transform(_between, (x, i) -> concat(x, if(i < size(_found), if(_found[i].score >= {threshold}, '{mark}', _found[i].c), '')))")
    return F.when(F.col(text_col).isNull(), F.lit(None)).otherwise(F.expr(f"array_join({pieces}, '')"))


def redact_secrets(docs: DataFrame, findings: DataFrame | None = None, mark: str = "<secret>", threshold: float = 0.5,
                   text_col: str = "text") -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; all rows and other columns, of any names, stay, a null text stays null."""
    forest = train_forest(findings if findings is not None else labelled_findings(docs.sparkSession))
    rows, the_text = aliased(docs, text_col)
    clean = _examined(rows, forest, the_text).withColumn(the_text, redacted_text(the_text, mark, threshold))
    return clean.select(*rows.columns).toDF(*docs.columns)
