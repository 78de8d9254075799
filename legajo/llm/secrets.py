"""Secret scan: candidates by shape, false positives removed by a random forest.

A candidate is a run of sixteen or more characters of the alphabets that keys are written in, with a digit or both cases in it, or
the whole value assigned to a credential's name, whatever its length and signs. The forest judges its length, how its characters follow each other, how much of it a dictionary covers, the path of the
document and the words next to it. It is trained on labelled findings. Everything on the way is a DataFrame function: candidates are found and
measured where the text is read, and no text is shuffled.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHAPE = r"[A-Za-z0-9+/_=-]{16,}"
GAP = r"[\x20\x09-\x0D]+"
#: Words that name a credential, words that name another kind of digest, and frequent letter groups of words.
KEY_WORDS = r"(?i)(token|secret|passw|pwd|api.?key|access.?key|private.?key|credential|auth|bearer)"
OTHER_WORDS = r"(?i)(commit|sha-?1|sha-?256|md5|checksum|digest|etag|revision|uuid|build|hash)"
#: A credential's name and an assignment; and with the value, in quotes or up to white space.
NAMED = (
    r"(?i)(?:token|secret|passw|pwd|api.?key|access.?key|private.?key|credential|auth(?!or(?!iz))|bearer)[\w.-]{0,64}+[\"'`\]]{0,2}"
    r"[ \t]{0,8}(?::=|=>|[=:])(?![=:])[ \t]{0,8}(?:(?:bearer|basic|token)[ \t]{1,8})?"
)
ASSIGNED = NAMED + r"(?:\"(?!\")[^\r\n]+?(?<!\\)\"|'(?!')[^\r\n]+?(?<!\\)'|`[^`\r\n]+`|[^\x20\x09-\x0D]+)"
TEST_PATH = r"(?i)(test|spec|example|sample|fixture|mock|docs?)([/._-]|$)"
SYLLABLES = "the|and|ing|ion|ent|ter|est|ver|ein|sch|ung|lich|heit|keit|che|con|que|les|ment|ous|elle|ado|cion|para|tion|er|en|on|an|re|ou|st|th|he|in"
FEATURES = [
    "length", "digit_share", "upper_share", "symbol_share", "kinds", "changes", "letter_digit", "distinct_share", "hex_only",
    "covered_share", "key_before", "other_before", "assigned", "quoted", "path_depth", "path_test",
]


def _keylike(run: Column) -> Column:
    """Whether a run has a digit or changes between both cases."""
    return run.rlike(r"[0-9]") | (run.rlike("[a-z][A-Z]") & run.rlike("[A-Z][a-z]"))


def candidates(docs: DataFrame, text: str = "text", path: str = "source") -> DataFrame:
    """One row per candidate: the columns of ``docs`` but ``text``, with candidate, before, after and path.

    Candidates are runs by SHAPE and values by ASSIGNED; a value that is such a run is one candidate. ``before`` has the three words in front and what
    the own word has before the candidate, for a value its name as well; ``after`` the rest of the word and the next one. A null text has no
    candidates, a null path is empty; repeated candidates are findings of their own. Words of any length are searched whole.
    """
    return _runs(docs, text, path).unionByName(_values(docs, text, path))


def _values(docs: DataFrame, text: str, path: str) -> DataFrame:
    """Values assigned to a credential's name that are no candidates by shape."""
    kept = [c for c in docs.columns if c not in (text, "candidate", "before", "after", "path")]
    some = docs.filter(F.col(text).rlike(ASSIGNED))
    # The text is cut at its assignments; each has the piece in front of it and the one behind. Through an explode, as below.
    parts = F.struct(F.regexp_extract_all(text, F.lit(ASSIGNED), F.lit(0)).alias("hits"), F.split(text, ASSIGNED).alias("pieces"))
    df = some.select(*[F.col(c) for c in kept], F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), F.explode_outer(F.array(parts)).alias("__parts"))
    cut = F.transform(
        F.col("__parts.hits"),
        lambda hit, i: F.struct(hit.alias("hit"), F.get("__parts.pieces", i).alias("front"), F.get("__parts.pieces", i + 1).alias("behind")),
    )
    df = df.select(*kept, "path", F.inline(cut))
    df = df.withColumn("__name", F.regexp_extract("hit", "^" + NAMED, 0))
    df = df.withColumn("candidate", F.substring("hit", F.length("__name") + 1, F.length("hit")))
    quote = F.regexp_extract("candidate", r"^([\"'`])[^\r\n]+\1$", 1)
    df = df.withColumn("__quote", quote)
    df = df.withColumn("candidate", F.substring("candidate", F.length("__quote") + 1, F.length("candidate") - 2 * F.length("__quote")))
    last = F.split("front", GAP)
    df = df.withColumns(
        {
            "before": F.concat(F.concat_ws(" ", F.slice(last, F.greatest(F.size(last) - 3, F.lit(1)), 4)), "__name", "__quote"),
            "after": F.concat("__quote", F.concat_ws(" ", F.slice(F.split(F.coalesce("behind", F.lit("")), GAP), 1, 2))),
        }
    )
    run = F.col("candidate").rlike(f"^{SHAPE}$") & _keylike(F.col("candidate")) & ~F.col("before").rlike("[A-Za-z0-9+/_=-]$")
    df = df.filter(F.col("candidate").rlike(r"[\p{L}\p{N}]") & ~run)
    return df.select(*kept, "path", "candidate", "before", "after")


def _runs(docs: DataFrame, text: str = "text", path: str = "source") -> DataFrame:
    """Candidates by shape."""
    kept = [c for c in docs.columns if c not in (text, "candidate", "before", "after", "path")]
    words = F.split(F.coalesce(F.col(text), F.lit("")), GAP)
    # Through an explode of one row, so that the lambda does not split the text again for each word.
    df = docs.select(*[F.col(c) for c in kept], F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), F.explode_outer(F.array(words)).alias("__words"))
    word = lambda i: F.coalesce(F.get("__words", i), F.lit(""))
    hit = F.filter(F.sequence(F.lit(0), F.size("__words") - 1), lambda i: (F.length(word(i)) >= 16) & word(i).rlike(SHAPE))
    found = F.transform(
        hit,
        lambda i: F.struct(
            word(i).alias("word"), F.concat_ws(" ", *[F.when(i >= k, word(i - k)) for k in (3, 2, 1)]).alias("before"), word(i + 1).alias("after")
        ),
    )
    df = df.select(*kept, "path", F.inline(found))
    df = df.withColumn("candidate", F.explode(F.regexp_extract_all("word", F.lit(SHAPE), F.lit(0))))
    at = F.instr("word", F.col("candidate"))
    df = df.withColumns(
        {
            "before": F.concat_ws(" ", "before", F.substring("word", F.lit(1), at - 1)),
            "after": F.concat_ws(" ", F.substring("word", at + F.length("candidate"), F.length("word")), "after"),
        }
    ).drop("word")
    return df.filter(_keylike(F.col("candidate"))).select(*kept, "path", "candidate", "before", "after")


def measured(findings: DataFrame) -> DataFrame:
    """``findings`` with FEATURES, of candidate, before, after and path; nulls count as empty."""
    c, before, after, path = (F.coalesce(F.col(x), F.lit("")) for x in ("candidate", "before", "after", "path"))
    n = F.greatest(F.length(c), F.lit(1))
    kept = lambda pattern: F.length(F.regexp_replace(c, pattern, ""))
    pairs = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    flag = lambda x: x.cast("double")
    columns = {
        "length": n,
        "digit_share": kept("[^0-9]") / n,
        "upper_share": kept("[^A-Z]") / n,
        "symbol_share": kept("[A-Za-z0-9]") / n,
        "kinds": flag(c.rlike("[0-9]")) + flag(c.rlike("[a-z]")) + flag(c.rlike("[A-Z]")),
        "changes": pairs("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]"),
        "letter_digit": pairs("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]"),
        "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / n,
        "hex_only": flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "covered_share": 1 - F.length(F.regexp_replace(F.lower(c), SYLLABLES, "")) / n,
        "key_before": flag(before.rlike(KEY_WORDS)),
        "other_before": flag(before.rlike(OTHER_WORDS)),
        "assigned": flag(before.rlike(r"[=:]\W*$")),
        "quoted": flag(before.rlike("[\"'`]$") & after.rlike("^[\"'`]")),
        "path_depth": F.length(F.regexp_replace(path, "[^/]", "")),
        "path_test": flag(path.rlike(TEST_PATH)),
    }
    return findings.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in columns.items()})


def drawn_findings(spark: SparkSession, n: int = 400) -> DataFrame:
    """Labelled findings (candidate, before, after, path, label) that are drawn by rule, ``n`` of each kind.

    Keys in the usual alphabets after a word that names them are secrets; the same shapes after the words of other
    digests, numbers, and joined dictionary words are not, whatever stands in front.
    """
    rows = spark.range(n).select("id", F.sha1(F.col("id").cast("string")).alias("hex"), F.sha2(F.col("id").cast("string"), 384).alias("long"))
    pick = lambda *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.pmod("id", F.lit(len(xs))) + 1).cast("int"))
    base64 = F.regexp_replace(F.base64(F.unhex(F.substring("long", 1, 60))), "=", "")
    key = F.when(F.pmod("id", F.lit(3)) == 0, base64).when(F.pmod("id", F.lit(3)) == 1, F.col("hex")).otherwise(F.upper("hex"))
    name = pick("token", "secret_key", "api_key", "password", "AUTH_TOKEN", "client_secret", "credential")
    sign = F.element_at(F.array(F.lit(" = \""), F.lit(": '"), F.lit("="), F.lit(": ")), (F.pmod(F.floor(F.col("id") / 7), F.lit(4)) + 1).cast("int"))
    quote = F.regexp_extract(sign, "[\"']", 0)
    other = pick("commit", "sha1:", "etag", "checksum =", "md5", "revision", "build")
    number = F.substring(F.regexp_replace("long", "[a-f]", ""), 1, 16)
    syllables = F.split(F.lit(SYLLABLES), r"\|")
    words = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(8)), lambda k: F.element_at(syllables, (F.pmod(F.xxhash64("id", k), F.size(syllables)) + 1).cast("int"))))
    kinds = [
        (key, F.concat(name, sign), quote, 1),
        (key, F.concat(F.lit("of the "), name, sign), quote, 1),
        (F.col("hex"), F.concat(other, F.lit(" ")), F.lit(" on"), 0),
        (number, F.concat(pick("card", "from", "for", "on", "token", "with", "los"), F.lit(" ")), F.lit(" in"), 0),
        (F.concat(words, number), F.concat(name, sign), quote, 0),
        (F.concat_ws("-", F.initcap(words), words), pick("the ", "a ", "in ", "token "), F.lit(" and"), 0),
        (F.concat(words, F.lit("/"), F.substring(number, 1, 4), F.lit("/"), words), F.lit("http://"), F.lit(""), 0),
    ]
    # Short and signed values, and what else is assigned to such names.
    assigned = F.concat(name, sign)
    few = lambda k: F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(k)), lambda j: F.element_at(syllables, (F.pmod(F.xxhash64("id", j + 20), F.size(syllables)) + 1).cast("int"))))
    mark = F.element_at(F.split(F.lit("& ! @ # $ % . * ?"), " "), (F.pmod(F.xxhash64("id"), F.lit(9)) + 1).cast("int"))
    size = lambda least, n: (F.pmod(F.xxhash64("id", F.lit(n)), F.lit(n)) + least).cast("int")
    letters = F.substring(F.translate("hex", "0123456789abcdef", "qzkfhwmrtbxplcvd"), F.lit(1), size(8, 25))
    others = F.substring(F.translate("hex", "0123456789abcdef", "ngysujwkxidbmqzv"), F.lit(1), size(8, 25))
    digits = F.substring(number, 1, 4)
    word = F.concat(few(2), F.when(F.pmod("id", F.lit(2)) == 0, few(1)).otherwise(""))
    fixed = pick("required", "None", "null", "true", "string", "optional", "${PASSWORD}", "<token>", "$TOKEN", "getToken()", "self.password", "str,", "false", "3600", "30", "the")
    kinds += [
        (F.concat(F.initcap(few(1)), F.substring(number, 1, 1), few(1), F.substring(number, 2, 1), mark, F.substring(number, 3, 2)), assigned, quote, 1),
        (F.concat(F.substring("long", 5, 2), mark, F.initcap(few(1)), F.substring(number, 1, 1), F.lit("!"), digits, mark, F.substring("long", 9, 3)), assigned, quote, 1),
        (F.concat(F.substring("hex", 1, 6), mark, F.upper(F.substring("hex", 9, 4))), assigned, quote, 1),
        (F.substring(base64, F.lit(1), size(9, 7)), assigned, quote, 1),
        (F.substring("hex", F.lit(1), size(10, 6)), assigned, quote, 1),
        (F.when(F.pmod("id", F.lit(2)) == 0, letters).otherwise(others), assigned, quote, 1),
        (word, assigned, quote, 0),
        (F.initcap(word), F.concat(name, F.lit(": ")), F.concat(F.lit(" "), few(1)), 0),
        (fixed, F.concat(name, pick(" = ", ": ", "=")), F.lit(""), 0),
    ]
    structs = [
        F.struct(c.alias("candidate"), b.alias("before"), a.alias("after"), pick("src/main", "conf", "web", "lib/test/data").alias("path"), F.lit(y).alias("label"))
        for c, b, a, y in kinds
    ]
    return rows.select(F.inline(F.array(*structs)))


def fit(labelled: DataFrame, trees: int = 40, depth: int = 8) -> RandomForestClassificationModel:
    """A forest from labelled findings: candidate, before, after, path and label (1 secret, 0 not); a null label is left out."""
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(measured(labelled.filter("label is not null")))
    return RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, seed=11).fit(rows)


def judged(findings: DataFrame, forest: RandomForestClassificationModel, cut: float = 0.5) -> DataFrame:
    """``findings`` with ``secret_score`` and ``is_secret``."""
    rows = VectorAssembler(inputCols=FEATURES, outputCol="__features").transform(measured(findings))
    forest = forest.copy().setFeaturesCol("__features")
    score = vector_to_array("probability")[1]
    rows = forest.transform(rows).withColumns({"secret_score": score, "is_secret": score >= cut})
    return rows.select(*findings.columns, "secret_score", "is_secret")


def corpus_findings(found: DataFrame, most: int = 5_000) -> DataFrame:
    """Findings of a corpus labelled by their surest signs, ``most`` of each label at most, drawn by hash.

    A key-like run behind an assignment to a credential's name is a secret; a number, and a run that syllables cover, is not.
    """
    numbers = measured(found)
    yes = (F.col("key_before") + F.col("assigned") + F.col("quoted") == 3) & (F.col("letter_digit") > 0.2)
    no = (F.col("digit_share") > 0.99) | (F.col("covered_share") > 0.8)
    rows = numbers.select("candidate", "before", "after", "path", F.when(yes, 1).when(no, 0).alias("label")).filter("label is not null")
    order = [F.xxhash64("candidate", "before"), F.col("candidate"), F.col("before"), F.col("after"), F.col("path")]
    parts = [rows.filter(F.col("label") == y).orderBy(*order).limit(most) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def masked(docs: DataFrame, forest: RandomForestClassificationModel, doc: str = "doc_id", text: str = "text", path: str = "source", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``.

    Rows without a run of the right shape or an assigned value are passed on as they are; the others meet their findings by a digest of their text, so that
    equal texts are masked alike and null or repeated ids do no harm. A secret that is no run by SHAPE is masked where no letter or digit is next to it.
    """
    shaped = F.coalesce(F.col(text).rlike(SHAPE) | F.col(text).rlike(ASSIGNED), F.lit(False))
    key = F.sha2(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8"), 256)
    some = docs.filter(shaped).withColumn("__key", key)
    found = judged(candidates(some.select("__key", text, path), text, path), forest).filter("is_secret")
    found = found.groupBy("__key").agg(F.array_sort(F.collect_set("candidate"), lambda a, b: F.length(b) - F.length(a)).alias("__secrets"))
    some = some.join(found, "__key", "left")

    def replaced(t: Column, s: Column) -> Column:
        alone = F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), F.replace(s, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![\p{L}\p{N}])"))
        return F.when(s.rlike(f"^{SHAPE}$"), F.replace(t, s, F.lit(mark))).otherwise(F.regexp_replace(t, alone, F.lit(mark.replace("\\", "\\\\").replace("$", "\\$"))))

    cleaned = F.aggregate(F.coalesce("__secrets", F.array().cast("array<string>")), F.col(text), replaced)
    some = some.withColumn("__clean", cleaned).select(*[F.col("__clean").alias(c) if c == text else F.col(c) for c in docs.columns])
    return docs.filter(~shaped).unionByName(some)
