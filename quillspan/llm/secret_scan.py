"""Secret scan in DataFrame expressions: candidates by pattern, false positives removed by a random forest.

Candidates are runs of key-like characters with a digit, or that begin like a known credential, and all values assigned
to secret words. Each is described by its
length, its steps from one kind of character to another, the share of letter pairs that are frequent in words, the share that dictionary words cover, whether it or its document's path
looks like a path or a test, and by words and signs before it. A random forest (Spark's own, in the JVM) trained from labelled
findings gives the chance that it is a secret. No Python runs on the executors.

Labelled findings come as a table (value, before, path, label); without one, `labelled_findings` makes one by rules: keys
of known kinds and random tokens in assignments, against hashes, ids, card numbers, versions, paths and placeholders.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: How known credentials begin, words that name secrets or harmless values, and common words of identifiers.
KNOWN = {
    "aws_access_key": r"(?:AKIA|ASIA)[0-9A-Z]{16}",
    "github_token": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "slack_token": r"xox[abeprs]-[A-Za-z0-9-]{10,}",
    "stripe_key": r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}",
    "google_api_key": r"AIza[0-9A-Za-z_-]{35}",
    "json_web_token": r"eyJ[A-Za-z0-9_-]{10,}",
}
SECRET_WORDS = "token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|apikey|access[_-]?key|auth|bearer|credential|private[_-]?key"
HARMLESS_WORDS = "example|sample|dummy|test|fake|placeholder|sha1|sha256|md5|checksum|digest|commit|revision|uuid|guid|version|card|invoice|order|phone|isbn|build"
DICTIONARY = (
    "about access account active admin after api app apple array auth author base block build button center check "
    "class click client cloud code column commit company config console content count create custom data debug "
    "default demo design dev device document draft enable entry event example false field file first folder found "
    "function google group handle hash height help hidden home http https image import index info insert key "
    "language level light linux local login main master member message mobile module music name none null number "
    "office order other package page parent pass path pattern photo plain plugin position press print process prod "
    "profile project public queue random ready region release remove request resource result right sample schema "
    "script second secret secure server service session simple site small source space stage start static storage "
    "stream string submit support table template test text this thread time today token track type union update "
    "user value version video visit watch web widget window with world yellow your "
).split()
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?:(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}+|(?:AKIA|ASIA)[A-Z]{16}|xox[abeprs]-[A-Za-z-]{10,})"
#: Any value that a secret word is assigned, whatever its length and characters.
ASSIGNED = rf"(?i)(?:{SECRET_WORDS})[A-Za-z0-9_-]*[\"'`]?[ \t]*(?::=|=>|=|:)[ \t]*[\"'`]?([^\s\"'`,;]+)"
#: A known credential wherever it stands, in a path or behind a name and "=" too.
INSIDE = rf"(?<![A-Za-z0-9])(?:{'|'.join(KNOWN.values())})"
#: The most frequent pairs of letters in running English text.
PAIRS = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce".split()
#: Steps between lower-case and upper-case letters and digits, each a feature of its own.
STEPS = {f"{a}_{b}": rf"{x}(?={y})" for a, x in (("lower", "[a-z]"), ("upper", "[A-Z]"), ("digit", "[0-9]")) for b, y in (("lower", "[a-z]"), ("upper", "[A-Z]"), ("digit", "[0-9]"))}
FEATURES = f"length digits uppers lowers signs {' '.join(STEPS)} pairs distinct coverage path test_path assigned quoted secret_word harmless_word known hex_only digits_only".split()


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.greatest(F.length(value), F.lit(1))


def rule(value: Column) -> Column:
    out = None
    for name, pattern in KNOWN.items():
        test = value.rlike(f"^{pattern}$")
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("generic")


def features(found: DataFrame) -> DataFrame:
    """Adds FEATURES to columns value, before (up to 60 characters before it) and path."""
    v, b, path = F.col("value"), F.lower(F.coalesce("before", F.lit(""))), F.lower(F.coalesce("path", F.lit("")))
    word = "|".join(sorted(DICTIONARY, key=len, reverse=True))
    number = lambda c: c.cast("double")
    near = F.regexp_extract(b, r"((?:\S+\s+){0,3}\S*)$", 1)
    cols = {
        "length": number(F.length(v)), "digits": _share(v, "[0-9]"), "uppers": _share(v, "[A-Z]"), "lowers": _share(v, "[a-z]"),
        "signs": _share(v, "[+/_=-]"), **{name: _share(v, step) for name, step in STEPS.items()}, "pairs": _share(F.lower(v), f"(?={'|'.join(PAIRS)})"),
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / F.greatest(F.least(F.length(v), F.lit(64)), F.lit(1)),
        "coverage": 1 - F.length(F.regexp_replace(F.lower(v), word, "")) / F.greatest(F.length(v), F.lit(1)),
        "path": number(v.rlike("/[A-Za-z_-]+/|^/|--|=[^=]")), "test_path": number(path.rlike("test|example|sample|fixture|mock|docs?/")),
        "assigned": number(b.rlike(r"(?:=|:|=>)\s*[\"'`]?$")), "quoted": number(b.rlike("[\"'`]$")), "secret_word": number(near.rlike(SECRET_WORDS)),
        "harmless_word": number(F.concat(near, v).rlike(HARMLESS_WORDS)), "known": number(rule(v) != "generic"),
        "hex_only": number(v.rlike("^[0-9a-f]+$|^[0-9A-F]+$")), "digits_only": number(v.rlike("^[0-9]+$")),
    }
    return found.withColumns(cols)


def labelled_findings(spark: SparkSession, n: int = 4000) -> DataFrame:
    """Labelled findings by rules: n rows of value, before, path and label, in one partition, so that the forest is the same on every call."""
    rnd = lambda salt, bits=256: F.sha2(F.concat_ws("-", F.lit(salt), "id"), bits)
    b64 = lambda salt: F.regexp_replace(F.base64(F.unhex(rnd(salt, 512))), "[=\r\n]", "")
    pick = lambda salt, *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(len(xs))).cast("int") + 1)
    secret = F.concat(pick("w", "the ", "", "set ", "use our ", "# "), pick("n", "token", "secret", "password", "api_key", "apikey", "access_key", "auth_token", "db_passwd"), pick("o", " = \"", "=", ": ", " = '", " := \"", "=\""))
    plain = pick("p", "of the ", "commit ", "sha256: ", "md5 ", "order no ", "see ", "uuid ", "card ", "version ", "in ", "and ", "ref ", "id=", "build: ")
    upper = F.upper(F.substring(F.translate(b64("u"), "+/", "AB"), 1, 16))
    size = F.pmod(F.xxhash64(F.lit("s"), "id"), F.lit(25)).cast("int") + 20
    kinds = [  # label, value, before
        (1, F.substring(rnd("a"), 1, 40), secret), (1, F.substring(b64("b"), F.lit(1), size), secret), (1, rnd("c"), secret),
        (1, F.substring(rnd("p"), F.lit(1), size - 10), secret), (1, F.concat(pick("j", "Sun", "blue", "Mar", "kite"), F.substring(b64("w"), F.lit(1), size - 14)), secret),
        (1, F.concat(F.lit("AKIA"), upper), plain), (1, F.concat(F.lit("ghp_"), F.substring(F.translate(b64("g"), "+/", "xy"), 1, 36)), plain),
        (1, F.concat(F.lit("sk_live_"), F.substring(F.translate(b64("k"), "+/", "xy"), 1, 24)), secret),
        (0, F.substring(rnd("d"), 1, 40), plain), (0, F.substring(F.translate(rnd("e"), "abcdef", "123456"), 1, 16), plain), (0, F.substring(rnd("m"), 1, 32), plain),
        (0, F.concat_ws("-", *(F.substring(rnd("v"), i, k) for i, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), plain),
        (0, F.concat(pick("x", "your_api_token_", "example_password_", "test_secret_value_", "sample_key_"), F.col("id").cast("string")), secret),
        (0, F.concat(pick("y", "/usr/share/data/", "source/main/index_", "home/user/files/"), F.col("id").cast("string")), plain),
        (0, F.concat(F.repeat(pick("z", "x", "0", "1", "abc1"), 8), F.lit("xxxxxxxx0")), secret),
        (0, F.concat(pick("q", "international", "characterization", "responsibilities", "straightforwardly"), F.pmod("id", F.lit(97)).cast("string")), plain),
    ]
    kind = F.pmod("id", F.lit(len(kinds)))
    col = lambda j: F.coalesce(*[F.when(kind == i, k[j] if j else F.lit(k[0])) for i, k in enumerate(kinds)])
    return spark.range(0, n, 1, 1).select(col(1).alias("value"), col(2).alias("before"), pick("f", "src/app", "conf/prod", "lib/main", "", "tests/unit").alias("path"), col(0).cast("double").alias("label"))


def train(findings: DataFrame, trees: int = 24, depth: int = 7, seed: int = 11) -> PipelineModel:
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, maxBins=48)
    return PipelineModel([assembler, forest.fit(assembler.transform(features(findings)).select("features", "label"))])


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source", pattern: str = CANDIDATE, group: int = 0) -> DataFrame:
    """doc_id, value, start (1-based, in code points), before and path of every occurrence of a candidate in every text.

    group: the pattern's group that is the value; it stands at the match's end. A column `row` of docs is kept.
    """
    path = F.col(path_col) if path_col else F.lit(None).cast("string")
    kept = ["row"] if "row" in docs.columns else []
    base = docs.select(*kept, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), path.alias("path"))
    found = base.withColumn("all", F.regexp_extract_all("text", F.lit(pattern), F.lit(group))).where(F.size("all") > 0)
    # Texts between the matches, and what of a match stands before its value, add up to the places.
    whole = F.regexp_extract_all("text", F.lit(pattern), F.lit(0)) if group else F.col("all")
    sizes = F.zip_with(F.split("text", pattern, -1), whole, lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("size")))
    found = found.withColumn("sizes", F.slice(sizes, 1, F.size("all")))
    none = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("ends"))
    step = lambda acc, e: F.struct((acc["at"] + e["gap"] + e["size"]).alias("at"), F.concat(acc["ends"], F.array(acc["at"] + e["gap"] + e["size"])).alias("ends"))
    found = found.withColumn("ends", F.aggregate("sizes", none, step, lambda acc: acc["ends"]))
    # What stands before each is cut out while the text is at hand, so that rows stay small.
    each = F.zip_with("all", "ends", lambda v, end: F.struct(v.alias("value"), (end - F.length(v)).alias("start")))
    each = F.transform(each, lambda e: F.struct(e["value"].alias("value"), e["start"].alias("start"), F.substring(F.col("text"), F.greatest(e["start"] - 60, F.lit(1)), F.least(e["start"] - 1, F.lit(60))).alias("before")))
    return found.select(*kept, "doc_id", "path", F.inline(each)).select(*kept, "doc_id", "value", "start", "before", "path")


def candidates(docs: DataFrame, **columns) -> DataFrame:
    """The first occurrence of each different candidate of every text."""
    found = occurrences(docs.withColumn("row", F.monotonically_increasing_id()), **columns)
    first = found.groupBy("row", "value").agg(F.min_by(F.struct("doc_id", "start", "before", "path"), "start").alias("e"))
    return first.select("e.doc_id", "value", "e.start", "e.before", "e.path")


def secrets(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5, **columns) -> DataFrame:
    """Secrets of every document: doc_id, start, n_chars, rule, secret_sha256 and probability, one row for each different value:
    its first occurrence that passes, with the highest probability of all its occurrences. A known credential in a longer run, as
    in a path or behind a name and "=", is a finding of its own in the run's stead.

    Null and empty texts have none; a null id or path is kept as it is; repeated documents give repeated rows; an empty table
    gives an empty result; other columns are not read. Ties at the threshold are secrets.
    """
    model = train(findings if findings is not None else labelled_findings(docs.sparkSession))
    rows = docs.withColumn("row", F.monotonically_increasing_id())
    runs = occurrences(rows, **columns).union(occurrences(rows, pattern=ASSIGNED, group=1, **columns))
    # A run that holds a known credential beside other signs is not the secret: the credential is, at its own place.
    runs = runs.where(~(F.col("value").rlike(INSIDE) & (rule(F.col("value")) == "generic")))
    found = runs.union(occurrences(rows, pattern=INSIDE, **columns)).distinct()
    scored = model.transform(features(found)).withColumn("probability", vector_to_array("probability")[1]).where(F.col("probability") >= threshold)
    best = scored.groupBy("row", "value").agg(F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("probability").alias("probability"))
    return best.select(
        "doc_id", F.col("start").cast("long").alias("start"), F.length("value").cast("long").alias("n_chars"), rule(F.col("value")).alias("rule"), F.sha2("value", 256).alias("secret_sha256"), "probability"
    )
