"""Secret scans (operator 5): candidates by pattern, false positives removed by a random
forest. DataFrame and SQL functions only.

Candidates are runs of key characters with letters and digits, values assigned to a
secret's name, and private key headers, found in whole texts. The features of a candidate:
its length and kinds of characters, its character transitions (changes of kind, and the
mean log probability of its character pairs in ordinary words), dictionary coverage (share
of its characters inside frequent words), whether it is part of a path, an address or a
URL, and the neighbouring words (names of secrets, words of examples, assignment).

The forest (Spark ML) is trained on a bounded sample of labelled findings: ``finding``
rows with label 1 or 0. ``label_findings`` makes such labels where none are given: formats
of known vendors and assigned values are 1, parts of paths and addresses, examples, other
candidates of web pages, and ordinary long words are 0; ``example_findings`` adds forms
of which a corpus may hold too few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coldspot.llm.common import stored, unit_hash

BEFORE, AFTER = 48, 24  # characters of context
PER_LABEL = 2000
DICTIONARY_WORDS = 300
SECRET_FROM = 0.5
MASK = "[SECRET]"
_CUT = "\uf0f1"  # of the private use area

# Character class of keys, names of secrets, vendor formats, example words.
_KEY = r"[A-Za-z0-9+/_\-]"
_NAMES = "password|passwd|pwd|secret|token|api_key|apikey|api-key|access_key|auth_key|private_key|credential"
CANDIDATE = (
    r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
    rf"|(?<=[=:\"'\s])(?<=(?i:{_NAMES})[\"']?\s{{0,2}}[=:]\s{{0,2}}[\"']?)[^\s\"']{{6,}}"
    rf"|(?<!{_KEY})(?=[A-Za-z+/_\-]*+[0-9])(?=[0-9+/_\-]*+[A-Za-z]){_KEY}{{8,}}={{0,2}}")
VENDOR = (r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9\-]{10,}"
          r"|sk-[A-Za-z0-9\-_]{20,}|AIza[0-9A-Za-z_\-]{35}|-----BEGIN .*)$")
ASSIGNED = rf"(?i)({_NAMES})[\"']?\s{{0,2}}[=:]\s{{0,2}}[\"']?$"
EXAMPLE = r"(?i)(example|sample|placeholder|dummy|changeme|your[_\-]|xxxx|test[_\-]?key|fake|redacted)"
_ALPHABET = "abcdefghijklmnopqrstuvwxyz0"

FEATURES = ["f_length", "f_digits", "f_upper", "f_lower", "f_signs", "f_distinct", "f_hex", "f_kinds", "f_pairs",
            "f_dictionary", "f_path", "f_address", "f_named", "f_assigned", "f_quoted", "f_example"]


def _text_key(text):
    """A digest of the text: equal texts have equal candidates, and no other text has them."""
    return F.unhex(F.sha2(text, 256))


def _cut(text):
    """The text cut around its candidates: text, candidate, text, ..., text. Candidates are
    marked by a character that a text hardly holds; a text that does is cut by the pattern."""
    marked = F.split(F.regexp_replace(text, CANDIDATE, f"{_CUT}$0{_CUT}"), _CUT, -1)
    found = F.concat(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)), F.array(F.lit(None).cast("string")))
    by_pattern = F.flatten(F.zip_with(F.split(text, CANDIDATE, -1), found, lambda p, c: F.array(p, c)))
    return F.when(F.contains(text, F.lit(_CUT)), F.slice(by_pattern, F.lit(1), F.size(by_pattern) - 1)).otherwise(marked)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", places: bool = False) -> DataFrame:
    """(row, doc_id, start, finding, before, after): every candidate of every text, with its
    place (from 0, in characters) and the characters around it. ``row`` numbers the rows.
    ``places`` adds ``text_key``, a digest of the text, and ``k``, the candidate's number in
    its text (from 0). Null and empty texts have none; repeated rows give their own."""
    text = F.col("_text")
    cut = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"),
                      F.monotonically_increasing_id().alias("row"))
    ids = ["row", "doc_id"] + (["text_key"] if places else [])
    if places:
        cut = cut.withColumn("text_key", _text_key(text))
    # Text, candidate, text, ..., text: the pattern runs once over a text.
    cut, p = cut.select(*ids, _cut(text).alias("p")), F.col("p")
    numbers = F.when(F.size(p) > 1, F.sequence(F.lit(0), (F.size(p) - 3).cast("int"), F.lit(2)))
    found = cut.select(*ids, F.posexplode(F.transform(numbers, lambda i: F.struct(
        F.get(p, i + 1).alias("finding"),
        F.right(F.get(p, i), F.lit(BEFORE)).alias("left"),
        F.left(F.get(p, i + 2), F.lit(AFTER)).alias("right"),
        F.length(F.get(p, i)).alias("gap")))).alias("k", "f"))
    found = found.select(*ids, "k", "f.*")
    order = W.partitionBy("row").orderBy("k")
    # The context goes on through neighbouring candidates: of 6 characters or more each, so
    # these are enough.
    earlier = F.collect_list(F.concat("left", F.right("finding", F.lit(BEFORE)))).over(order.rowsBetween(-(BEFORE // 6), -1))
    later = F.collect_list(F.concat(F.left("finding", F.lit(AFTER)), "right")).over(order.rowsBetween(1, AFTER // 6))
    return found.select(
        "row", "doc_id", (F.sum(F.col("gap") + F.length("finding")).over(order.rowsBetween(W.unboundedPreceding, 0)) - F.length("finding"))
        .cast("long").alias("start"), "finding",
        F.right(F.concat(F.array_join(earlier, ""), "left"), F.lit(BEFORE)).alias("before"),
        F.left(F.concat("right", F.array_join(later, "")), F.lit(AFTER)).alias("after"), *(["text_key", "k"] if places else []))


def _classes(text):
    """Lower case, digits as 0, everything else dropped: the alphabet of the pair table."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]", "0"), "[^a-z0]", "")


class Language:
    """What ordinary words look like, from all documents: log probabilities of character
    pairs (at most 27 * 27) and the most frequent words."""

    def __init__(self, docs: DataFrame, words: int = DICTIONARY_WORDS):
        word = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("w")).where(F.length("w") > 0)
        counted = stored(word.groupBy("w").agg(F.count(F.lit(1)).alias("n")), "words")
        self.words = [r["w"] for r in counted.where(F.length("w") >= 4).orderBy(F.desc("n"), "w").limit(words).collect()]
        c = _classes(F.col("w"))
        pairs = counted.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c) - 1)),
                                                          lambda i: F.substring(c, i, F.lit(2)))).alias("pair"))
        counts = {r["pair"]: float(r["n"]) for r in pairs.where(F.length("pair") == 2).groupBy("pair").agg(
            F.sum("n").alias("n")).collect()}
        first: dict[str, float] = {}
        for pair, n in counts.items():
            first[pair[0]] = first.get(pair[0], 0.0) + n
        self.pairs = {a + b: (counts.get(a + b, 0.0) + 0.5) / (first.get(a, 0.0) + 0.5 * len(_ALPHABET))
                      for a in _ALPHABET for b in _ALPHABET}


def with_features(found: DataFrame, language: Language) -> DataFrame:
    """The findings with the columns of ``FEATURES``."""
    c = F.col("finding")
    n = F.greatest(F.length(c), F.lit(1))
    share = lambda pattern: (F.length(F.regexp_replace(c, pattern, "")) / n)
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    table = F.create_map(*[F.lit(x) for pair, p in language.pairs.items() for x in (pair, p)])
    letters = _classes(c)
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(letters) - 1))
    pair_cost = F.aggregate(F.transform(steps, lambda i: F.coalesce(F.log(F.element_at(table, F.substring(letters, i, F.lit(2)))), F.lit(-6.0))),
                            F.lit(0.0), lambda a, v: a + v) / F.size(steps)
    covered = (1 - F.length(F.regexp_replace(F.lower(c), "|".join(language.words), "")) / n) if language.words else F.lit(0.0)
    flag = lambda condition: F.when(condition, 1.0).otherwise(0.0)
    around = F.concat_ws(" ", "before", "finding", "after")
    return found.select(
        "*",
        n.cast("double").alias("f_length"), share("[^0-9]").alias("f_digits"), share("[^A-Z]").alias("f_upper"),
        share("[^a-z]").alias("f_lower"), share("[A-Za-z0-9]").alias("f_signs"),
        (F.size(F.array_distinct(F.split(c, ""))) / n).alias("f_distinct"),
        flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("f_hex"), (F.length(kinds) / n).alias("f_kinds"),
        pair_cost.alias("f_pairs"), covered.alias("f_dictionary"),
        flag(F.col("before").rlike(r"(://\S*|[\w.\-]/|\\|href=\"?|src=\"?)$") | F.col("after").rlike(r"^(/|\.[A-Za-z]{2,4}\b)")).alias("f_path"),
        flag(F.col("before").rlike(r"[@.]$") | F.col("after").rlike(r"^@|^\.\w+@")).alias("f_address"),
        flag(F.col("before").rlike(rf"(?i)({_NAMES})")).alias("f_named"),
        flag(F.col("before").rlike(r"[=:]\s{0,2}[\"']?$")).alias("f_assigned"),
        flag(F.col("before").rlike(r"[\"']$")).alias("f_quoted"),
        flag(around.rlike(EXAMPLE)).alias("f_example"))


def label_findings(found: DataFrame) -> DataFrame:
    """Adds ``label`` by rule: 1, 0 or null (not certain)."""
    c = F.col("finding")
    mixed = c.rlike("[0-9]") & c.rlike("[A-Za-z]")
    example = F.concat_ws(" ", "before", "finding", "after").rlike(EXAMPLE)
    inside = F.col("before").rlike(r"(://\S*|[\w.\-]/|@)$") | F.col("after").rlike(r"^(@|/|\.[A-Za-z]{2,4}\b)")
    return found.withColumn("label", F.when(example | inside, 0).when(
        c.rlike(VENDOR) | (F.col("before").rlike(ASSIGNED) & mixed & (F.length(c) >= 12)), 1))


def ordinary_words(docs: DataFrame, rows: int = PER_LABEL) -> DataFrame:
    """Long words of a bounded sample of texts, as findings that are no secrets: at most
    ``rows``, taken by hash. Null and empty texts have none."""
    total = max(1, docs.count())
    sample = docs.where(F.col("text").isNotNull() & (unit_hash("doc_id", F.lit(7)) < min(1.0, rows / total)))
    words = sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(F.array_distinct(
        F.regexp_extract_all("text", F.lit(r"[A-Za-z]{8,}"), F.lit(0)))).alias("finding"))
    words = words.where(unit_hash("finding", F.lit(7)) < 0.05).orderBy(
        unit_hash("finding", "doc_id", F.lit(8)), "finding", "doc_id").limit(rows)
    return words.select("doc_id", "finding", F.lit(" ").alias("before"), F.lit(" ").alias("after"), F.lit(0).alias("label"))


def example_findings(docs: DataFrame, rows: int = PER_LABEL // 2) -> DataFrame:
    """Labelled findings of forms that a corpus may hold too few of. The keys are digests of
    a bounded sample of doc_ids, so they differ: keys assigned to names and vendor formats
    (1); digests in paths, addresses and after words that announce an id, and placeholders
    (0)."""
    total = max(1, docs.count())
    ids = docs.where(F.col("doc_id").isNotNull() & (unit_hash("doc_id", F.lit(13)) < min(1.0, rows / total))).select(
        F.col("doc_id").cast("long").alias("doc_id")).distinct().orderBy(unit_hash("doc_id", F.lit(14)), "doc_id").limit(rows)
    digest = F.sha2(F.concat(F.lit("key:"), F.col("doc_id").cast("string")), 512)
    mixed = F.regexp_replace(F.base64(F.unhex(digest)), "[+/=\n\r]", "")
    ids = ids.select("doc_id", digest.alias("hex"), mixed.alias("mixed"), F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(30)).cast("int").alias("n"))
    pick = lambda values: F.get(F.array(*map(F.lit, values)), F.pmod("n", F.lit(len(values))))
    start, size = F.lit(1), F.col("n") + 10
    named = pick(["the password=", 'of token = "', "with secret: '", "set api_key = ", 'auth_key="', "passwd: "])
    rows = [
        (1, F.substring("mixed", start, size), named, pick([" ", '"', "'"])),
        (1, F.substring("hex", start, size + 8), named, pick([" ", '" the', "'"])),
        (1, F.concat(F.lit("AKIA"), F.upper(F.substring("mixed", start, F.lit(16)))), pick([" ", "of ", "= "]), F.lit(" ")),
        (1, F.concat(F.lit("ghp_"), F.substring("mixed", start, F.lit(36))), pick([" ", "of ", ": "]), F.lit(" ")),
        (0, F.substring("hex", start, size + 8), pick(["https://cdn.example.net/assets/", "src/build/", "commit ", "sha256:", "id=", "see #"]),
         pick([".js", "/", " "])),
        (0, F.substring("mixed", start, size), pick(["https://example.net/v/", "watch?v=", "user.", "image/"]), pick([" ", ".png", "@mail.example.com", "/"])),
        (0, F.concat(pick(["your-password-", "example-key-", "changeme", "dummy-token-"]), F.substring("n", 1, 2)), named, F.lit(" ")),
    ]
    return ids.select(F.explode(F.array(*[F.struct(F.lit(label).alias("label"), f.alias("finding"), b.alias("before"), a.alias("after"))
                                          for label, f, b, a in rows])).alias("x")).select("x.finding", "x.before", "x.after", "x.label")


def train(labelled: DataFrame, language: Language, per_label: int = PER_LABEL, trees: int = 40, depth: int = 6):
    """A forest from labelled findings (finding, before, after, label): at most ``per_label``
    of each label, taken by hash. None if the labels are all alike."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = labelled.where("label in (0, 1)").select("finding", "before", "after", F.col("label").cast("double").alias("label"))
    h = unit_hash("finding", "before", "after", F.lit(9))
    picked = None
    for value in (0.0, 1.0):
        own = rows.where(F.col("label") == value).orderBy(h, "finding", "before", "after").limit(per_label)
        picked = own if picked is None else picked.unionAll(own)
    picked = stored(with_features(picked, language).coalesce(1), "findings")
    labels = {r["label"] for r in picked.select("label").distinct().collect()}
    if len(labels) < 2:
        return None
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(picked)
    return RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, seed=11, featuresCol="features").fit(
        vectors.select("features", "label"))


def scored(found: DataFrame, language: Language, forest) -> DataFrame:
    """Adds ``score``, the forest's probability of a secret (0.0 without a forest)."""
    rows = with_features(found, language)
    if forest is None:
        return rows.drop(*FEATURES).withColumn("score", F.lit(0.0))
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(rows)
    rows = forest.transform(rows)
    return rows.withColumn("score", vector_to_array("probability")[1]).drop(
        *FEATURES, "features", "rawPrediction", "probability", "prediction")


def fit(docs: DataFrame, pages: DataFrame | None = None, found: DataFrame | None = None):
    """(language, forest) from documents and, for what is no secret, web pages. ``found`` are
    the candidates of the documents, if they are stored already."""
    language = Language(docs)
    keep = ["finding", "before", "after", "label"]
    found = candidates(docs) if found is None else found
    labelled = label_findings(found).select(keep).unionAll(ordinary_words(docs).select(keep))
    labelled = labelled.unionAll(example_findings(docs).select(keep))
    if pages is not None:
        page = pages.select(F.col("page_id").alias("doc_id"), F.concat_ws(" ", "url", "html").alias("text"))
        labelled = labelled.unionAll(label_findings(candidates(page)).withColumn(
            "label", F.coalesce("label", F.lit(0))).select(keep))
    # Written once: the sample of each label is a pass over it, not over the texts.
    return language, train(stored(labelled.where("label is not null"), "labelled"), language)


def scan(docs: DataFrame, language: Language, forest, secret_from: float = SECRET_FROM,
         found: DataFrame | None = None) -> DataFrame:
    """(doc_id, start, length, kind, finding, score, is_secret): every candidate of every
    document row, ``is_secret`` after the removal of false positives.

    Null and empty texts have no candidates; repeated rows and null doc_ids give their own
    rows; a score of exactly ``secret_from`` is a secret; other columns are ignored.
    ``found`` are the candidates of ``docs``, if they are stored already."""
    kind = F.when(F.col("finding").rlike(VENDOR), "vendor").when(F.col("before").rlike(ASSIGNED), "assigned").otherwise("token")
    return scored(candidates(docs) if found is None else found, language, forest).select(
        "doc_id", "start", F.length("finding").cast("long").alias("length"), kind.alias("kind"), "finding", "score",
        (F.col("score") >= secret_from).alias("is_secret"))


def _unused(docs: DataFrame, name: str) -> str:
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def mask(docs: DataFrame, language: Language, forest, secret_from: float = SECRET_FROM) -> DataFrame:
    """The rows of ``docs`` (all columns kept, whatever their names) with every secret in
    ``text`` replaced by ``MASK``, just where it was found: the same characters elsewhere in
    the text stay. A text's secrets depend on the text alone, so rows are matched by it and
    not by doc_id: null and repeated doc_ids are rows like others, equal texts are masked
    alike. Null texts, empty ones and texts without a secret stay as they are."""
    key, flags = _unused(docs, "_text_key"), _unused(docs, "_secrets")
    found = scored(candidates(docs, places=True), language, forest)
    secret = F.col("score") >= secret_from
    # One row for each text with a secret: whether its k-th candidate is one, by k.
    secrets = found.groupBy(F.col("text_key").alias(key)).agg(
        F.sort_array(F.collect_set(F.struct("k", secret.alias("secret")))).alias(flags), F.max(secret).alias("any")).where("any").drop("any")
    # Rows without a text match nothing; their own keys keep them apart.
    own = F.coalesce(_text_key(F.col("text")), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    joined = docs.withColumn(key, own).join(secrets, key, "left")
    # Part 2k + 1 is candidate k.
    masked = F.array_join(F.transform(_cut(F.col("text")), lambda p, i: F.when(
        (i % 2 == 1) & F.get(F.col(flags), F.floor(i / 2).cast("int"))["secret"], F.lit(MASK)).otherwise(p)), "")
    return joined.withColumn("text", F.when(F.col(flags).isNotNull(), masked).otherwise(F.col("text"))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
