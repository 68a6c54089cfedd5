"""Secret scans: candidate strings of texts, and a random forest that removes the false positives among them.

DataFrame functions and Spark ML only: nothing here runs Python on the executors. The forest learns from labelled
findings: secrets and look-alikes that are planted in stretches of the documents, so that their labels are known by
themselves and not by a rule on the features, and reviewed findings where the caller has some.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, hash_sample, written

CANDIDATE = r"[A-Za-z0-9+/_-]{16,}(?:\.[A-Za-z0-9+/_-]{4,})*={0,2}"  # a run, dotted parts that follow it, padding
MIXED = "[0-9]|[a-z][A-Z]"  # what a run without an assignment has
# fixed values: how private keys are written; headers of encrypted ones have single dashes, 64 of which are looked through
KEY_BLOCK = "-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----[^-]*+(?:-(?!----)[^-]*+){0,64}+-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
SECRET_NAME = "(?i)(passw(or)?d|passwd|pwd|secret|token|api.?key|access.?key|auth|credential)"  # fixed values: names that hold secrets
# fixed values: what separates a name from its value in one word, and what a value has not
ASSIGNED = SECRET_NAME + r"[A-Za-z0-9_.\]-]{0,40}[\"'`]{0,2}[:=]{1,2}[\"'`]{0,2}"
VALUE = r"(?![=:])[^\s\"'`,;<>]{4,}"
FEATURES = ("n", "digit_share", "upper_share", "hex_share", "vowel_share", "distinct_share", "change_share", "coverage", "slashes", "in_path", "assigned", "named", "quoted", "before_known", "after_known")
NAMES = ("password", "token", "api_key", "client_secret", "auth_token", "DB_PASSWORD", "secretKey", "access-key")  # what planted values are assigned to
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _share(c: Column, outside: str) -> Column:
    return F.length(F.regexp_replace(c, outside, "")) / F.length(c)


def dictionary(docs: DataFrame, most_words: int = 300) -> list[str]:
    """The most_words most frequent words of three to ten letters of all documents."""
    words = docs.select(F.explode(F.split(F.lower("text"), "[^\\p{L}]+")).alias("w")).where(F.length("w").between(3, 10))
    return [r.w for r in words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(most_words).collect()]


def candidates(docs: DataFrame, known: list[str]) -> DataFrame:
    """One row for each candidate: doc_id, word_no, part_no, candidate, named, label (None) and the features.

    Words are cut at white space; a candidate is a run of 16 or more key characters with a digit or a change from
    lower to upper case in it (and the dotted parts and padding after it), or, after an assignment to a secret's name,
    a value of four or more characters up to a quote, comma, semicolon or bracket. A block of a private key is one
    candidate over all its lines, at the word where it begins, with part_no -1 (the text's next blocks -2, -3 and so
    on); its lines may be candidates too. Encrypted keys with their headers, and PGP's, are such blocks. Texts without candidates, null and empty ones give no rows. Repeated rows give repeated rows.
    """
    words = F.split("text", r"\s+")
    follows = lambda p1, p2: (p1.rlike(SECRET_NAME) & p1.rlike("[=:]$")) | (p1.rlike("^(=|:|:=|=>)$") & p2.rlike(SECRET_NAME))
    get = lambda i: F.coalesce(F.get("words", i), F.lit(""))
    picked = F.filter(
        F.transform(F.col("words"), lambda w, i: F.when(((F.length(w) >= 16) & w.rlike(MIXED) & w.rlike(CANDIDATE)) | w.rlike(ASSIGNED + VALUE) | ((F.length(w) >= 4) & follows(get(i - 1), get(i - 2))), i)),
        lambda i: i.isNotNull(),
    )
    at = lambda k: get(F.col("i") + k)
    base = docs.where(F.length("text") >= 8).select(F.col("doc_id").cast("long").alias("doc_id"), words.alias("words"))
    base = base.select("doc_id", "words", F.explode(picked).alias("i"))
    base = base.select("doc_id", F.col("i").cast("long").alias("word_no"), at(0).alias("word"), at(-1).alias("p1"), at(-2).alias("p2"), at(1).alias("n1"))
    # a value comes before the runs that it has
    alone = F.regexp_extract_all("word", F.lit(f"((?<=^[\"'`(]{{0,2}}){VALUE}|{CANDIDATE})"), F.lit(0))
    within = F.regexp_extract_all("word", F.lit(f"((?<={ASSIGNED}){VALUE}|{CANDIDATE})"), F.lit(0))
    base = base.select("*", F.posexplode(F.when(follows(F.col("p1"), F.col("p2")), alone).otherwise(within)).alias("part_no", "candidate"))
    blocks = docs.where(F.col("text").contains("PRIVATE KEY")).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.regexp_extract_all("text", F.lit(KEY_BLOCK), F.lit(0)).alias("found"), F.split("text", KEY_BLOCK).alias("gaps"))
    blocks = blocks.select("doc_id", "text", "found", "gaps", F.posexplode("found").alias("k", "candidate"))
    long = lambda parts: F.aggregate(parts, F.lit(0), lambda n, part: n + F.length(part))
    place = long(F.slice("gaps", F.lit(1), F.col("k") + 1)) + long(F.slice("found", F.lit(1), F.col("k")))
    ahead = F.split(F.col("text").substr(F.lit(1), place), r"\s+")
    get_last = lambda k: F.coalesce(F.try_element_at(ahead, F.lit(-k)), F.lit(""))
    blocks = blocks.select("doc_id", (F.size(ahead) - 1).cast("long").alias("word_no"), F.col("candidate").alias("word"), get_last(2).alias("p1"), get_last(3).alias("p2"), F.lit("").alias("n1"), (-1 - F.col("k")).alias("part_no"), "candidate")
    base = base.unionByName(blocks)
    c, n = F.col("candidate"), F.length("candidate")
    shape = F.translate(F.translate(F.translate(c, LETTERS, "a" * 26), LETTERS.upper(), "A" * 26), "0123456789", "0" * 10)
    before = F.expr("substring_index(word, candidate, 1)")
    around = F.concat_ws(" ", "p2", "p1", before)
    clean = lambda w: F.regexp_replace(F.lower(w), "[^\\p{L}]", "")
    covered = "(" + "|".join(sorted((w for w in known if w.isalpha()), key=lambda w: (-len(w), w))) + ")" if known else "(?!)"
    flag = lambda x: x.cast("double")
    found = base.select(
        "doc_id", "word_no", F.col("part_no").cast("long").alias("part_no"), "candidate",
        n.cast("double").alias("n"),
        _share(c, "[^0-9]").alias("digit_share"),
        _share(c, "[^A-Z]").alias("upper_share"),
        _share(c, "[^0-9a-fA-F]").alias("hex_share"),
        _share(c, "[^aeiouAEIOU]").alias("vowel_share"),
        (F.size(F.array_distinct(F.split(c, ""))) / n).alias("distinct_share"),
        ((F.length(F.regexp_replace(shape, r"(.)\1+", "$1")) - 1) / n).alias("change_share"),
        (1 - F.length(F.regexp_replace(F.lower(c), covered, "")) / n).alias("coverage"),
        F.length(F.regexp_replace(c, "[^/]", "")).cast("double").alias("slashes"),
        flag(F.col("word").rlike("://|^www\\.|\\.(com|org|net|html?)\\b")).alias("in_path"),
        flag(before.rlike("[=:]\\W*$") | F.col("p1").rlike("^(=|:|:=|=>)$|[=:]$")).alias("assigned"),
        flag(around.rlike(SECRET_NAME)).alias("named"),
        flag(before.rlike("[\"'`]$")).alias("quoted"),
        flag(clean(F.col("p1")).isin(known)).alias("before_known") if known else F.lit(0.0).alias("before_known"),
        flag(clean(F.col("n1")).isin(known)).alias("after_known") if known else F.lit(0.0).alias("after_known"),
    )
    return found.where(((F.col("n") >= 16) & F.col("candidate").rlike(MIXED)) | ((F.col("assigned") == 1) & (F.col("named") == 1)))


def planted(docs: DataFrame, most_docs: int = 1000, stretch: int = 600) -> DataFrame:
    """doc_id (a new one), text, planted and label: findings whose label is known, as each was put there.

    Of at most most_docs different documents, chosen by a hash, a stretch of `stretch` characters at a hashed place gets
    one of the kinds of secrets (label 1) and look-alikes (label 0) below between two of its words, once for each kind.
    Values follow from the document and the kind, so that each run plants the same ones.
    """
    text = F.col("text").cast("string")
    place = F.pmod(F.xxhash64(text, F.lit("place")), F.greatest(F.length(text) - stretch + 1, F.lit(1)).cast("long")).cast("int") + 1
    cut = docs.where(F.length(text) > 0).select("doc_id", text.alias("text"), text.substr(place, F.lit(stretch)).alias("stretch"))
    drawn = hash_sample(cut, F.xxhash64("doc_id", "text"), most_docs, ["doc_id", "stretch"])
    r = lambda kind: F.sha2(F.concat_ws(":", F.col("doc_id").cast("string"), F.lit(kind), "stretch"), 512)
    number = lambda kind, n: F.pmod(F.xxhash64(r(kind)), F.lit(n)).cast("int")
    hexes = lambda kind, n: F.substring(r(kind), 1, n)
    digits = lambda kind, n: F.substring(F.translate(r(kind), "abcdef", "123456"), 1, n)
    mixed = lambda kind, n: F.regexp_replace(F.concat(F.base64(F.unhex(r(kind))), F.base64(F.unhex(r(kind + "+")))), "[+/=\\s]", "").substr(F.lit(1), F.lit(n) if isinstance(n, int) else n)
    base64 = lambda kind, n: F.substring(F.regexp_replace(F.base64(F.unhex(r(kind))), "\\s", ""), 1, n)
    word = lambda k: F.lower(F.regexp_replace(F.coalesce(F.get("words", F.pmod(F.xxhash64(r(k)), F.greatest(F.size("words"), F.lit(1)).cast("long")).cast("int")), F.lit("")), "[^\\p{L}]", ""))
    title = lambda k: F.initcap(word(k))
    named = F.element_at(F.array(*map(F.lit, NAMES)), 1 + number("name", len(NAMES)))
    sign = F.element_at(F.array(*map(F.lit, ("=", ": ", " = ", ":", " := "))), 1 + number("sign", 5))
    quote = F.element_at(F.array(*map(F.lit, ("", "\"", "'"))), 1 + number("quote", 3))
    set_to = lambda v: F.concat(named, sign, quote, v, quote)
    kinds = [
        (1.0, set_to(hexes("a", 40))),
        (1.0, set_to(r("b").substr(F.lit(1), F.lit(12) + number("b", 40)))),
        (1.0, set_to(mixed("c", F.lit(9) + number("c", 12)))),
        (1.0, set_to(F.concat(mixed("d", 6), F.lit("!"), digits("d", 3), F.lit("$"), mixed("d2", 3)))),
        (1.0, set_to(base64("e", 40))),
        (1.0, F.concat(F.lit("AKIA"), F.upper(mixed("f", 16)))),
        (1.0, F.concat(F.lit("ghp_"), mixed("g", 36))),
        (1.0, F.concat(F.lit("eyJ"), mixed("h", 33), F.lit("."), mixed("i", 60), F.lit("."), mixed("j", 43))),
        (1.0, F.concat(F.lit("-----BEGIN PRIVATE KEY-----\n"), base64("k", 64), F.lit("\n"), base64("k2", 64), F.lit("\n-----END PRIVATE KEY-----"))),
        (0.0, digits("l", 16)),
        (0.0, F.concat(F.lit("commit "), hexes("m", 40))),
        (0.0, F.concat(F.lit("sha256:"), hexes("n", 64))),
        (0.0, F.concat(F.lit("https://www.example.org/"), word("o"), F.lit("/"), hexes("o", 24), F.lit(".html"))),
        (0.0, F.concat_ws("-", hexes("p", 8), hexes("p2", 4), hexes("p3", 4), hexes("p4", 4), hexes("p5", 12))),
        (0.0, F.concat(word("q"), title("q2"), title("q3"), title("q4"), digits("q", 2))),
        (0.0, F.concat(F.lit("/usr/lib/"), word("s"), digits("s", 1), F.lit("/"), word("s2"), F.lit("-"), word("s3"), F.lit("/"), word("s4"), F.lit(".conf"))),
        (0.0, set_to(word("t"))),
        (0.0, F.concat(named, F.lit("="), F.lit("https://www.example.org/"), word("u"), F.lit("/"), digits("u", 8))),
        (0.0, F.concat(F.lit("tel "), digits("v", 10), F.lit("-"), digits("v2", 6))),
        (0.0, set_to(F.concat(word("w"), title("w2"), F.lit("_"), word("w3")))),
    ]
    drawn = drawn.withColumn("words", F.split("stretch", r"\s+"))
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("kind"), F.lit(y).alias("label"), v.alias("planted")) for i, (y, v) in enumerate(kinds)))).alias("x")
    rows = drawn.select("doc_id", "stretch", "words", each).select("doc_id", "stretch", "words", "x.*").withColumn("at", F.pmod(F.xxhash64("stretch", "kind"), F.size("words").cast("long") + 1).cast("int"))
    text = F.concat_ws(" ", F.array_join(F.slice("words", 1, F.col("at")), " "), "planted", F.array_join(F.slice("words", F.col("at") + 1, F.size("words")), " "))
    return rows.select(F.xxhash64("doc_id", "stretch", "kind").alias("doc_id"), text.alias("text"), "planted", "label")


def labelled(docs: DataFrame, known: list[str], **options) -> DataFrame:
    """Candidates of planted(docs) that lie in what was planted, with its label."""
    put = written(planted(docs, **options), "planted")
    found = candidates(put, known).join(put.select("doc_id", "planted", "label"), "doc_id")
    return found.where(F.col("planted").contains(F.col("candidate")) & ~F.regexp_replace("candidate", "[=:]", "").isin(*NAMES)).drop("planted")


def train(rows: DataFrame, label: Column, most_rows: int = 40_000, trees: int = 20, depth: int = 8, seed: int = 11) -> RandomForestClassificationModel | None:
    """A forest on the labelled rows; None if they don't have both labels.

    Of over most_rows rows, each label gives at most half as many different ones, chosen by a hash, which weigh as much
    as all of its rows.
    """
    labels = rows.withColumn("label", label).where(F.col("label").isNotNull())
    n = {r.label: r["count"] for r in labels.groupBy("label").count().collect()}
    if len(n) < 2:
        return None
    most = most_rows // 2 if sum(n.values()) > most_rows else most_rows
    by, columns = F.xxhash64("doc_id", "word_no", "part_no"), ["doc_id", "word_no", "part_no", "label", *FEATURES]
    drawn = [hash_sample(labels.where(F.col("label") == x), by, most, columns).withColumn("weight", F.lit(max(1.0, n[x] / most))) for x in sorted(n)]
    chosen = written(drawn[0].unionByName(drawn[1]), "findings")
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed)
    model = forest.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(chosen))
    forget(chosen)
    return model


def scored(model: RandomForestClassificationModel, rows: DataFrame) -> DataFrame:
    """rows and score, the forest's probability that a candidate is a secret."""
    return model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)).withColumn("score", vector_to_array("probability")[1])


def scan(docs: DataFrame, least: float = 0.5, findings: DataFrame | None = None) -> DataFrame:
    """doc_id, word_no, part_no, candidate_sha256, n_chars, score and is_secret of every candidate in docs.

    score is the forest's probability that the candidate is a secret; is_secret says whether it is `least` or more. The
    forest learns from planted findings, and from findings (candidate_sha256, label 0 or 1) where they are given: each
    candidate with such a digest is labelled by it. An empty table gives no rows. Other columns of docs are ignored.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    known = dictionary(docs)
    rows = written(candidates(docs, known), "candidates")
    lessons = labelled(docs, known)
    if findings is not None:
        reviewed = findings.groupBy("candidate_sha256").agg(F.max("label").cast("double").alias("label"))
        lessons = lessons.unionByName(rows.withColumn("candidate_sha256", F.sha2("candidate", 256)).join(reviewed, "candidate_sha256").drop("candidate_sha256"))
    model = train(written(lessons, "lessons"), F.col("label"))
    judged = scored(model, rows) if model is not None else rows.withColumn("score", F.lit(0.0))
    return judged.select("doc_id", "word_no", "part_no", F.sha2("candidate", 256).alias("candidate_sha256"), F.col("n").cast("long").alias("n_chars"), "score", (F.col("score") >= least).alias("is_secret"))
