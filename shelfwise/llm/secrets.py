"""Secret scans with a random forest that removes false positives.

Candidates come from patterns; a random forest over their length, character
transitions, dictionary coverage, path-like surroundings and neighbouring words
decides which are secrets.  It is trained from labelled findings: the caller's, or
those of ``findings.labelled_findings``.  Only DataFrame functions and the DataFrame
learner run, no Python on the executors.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stage
from shelfwise.llm.findings import labelled_findings

# Names that introduce a credential, and the published shape of an access key id.
CREDENTIAL_NAMES = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "access_key", "auth")
ACCESS_KEY = r"AKIA[0-9A-Z]{16}"
PLACEHOLDERS = ("example", "sample", "dummy", "changeme", "placeholder", "xxxxxx", "yourkey", "redacted")

# A candidate: ``least`` or more characters of keys and encodings that stand alone.
_CANDIDATE = r"(?<![A-Za-z0-9+/_.@-])([A-Za-z0-9+/_.@-]{%d,}={0,2})(?![A-Za-z0-9+/_@-])"
# A value: what follows a credential name and an assignment, up to the closing quote or blank, of any length.
# The match ends before the value, so that a name inside a value has its own.
_NAMES = "|".join(CREDENTIAL_NAMES)
_ASSIGN = r"[\"']?\s{0,8}(?:=>|:=|={1,3}|::?)\s{0,8}"
ASSIGNED = (r"(?<![A-Za-z0-9+/_.@-])[A-Za-z0-9+/_.@-]*?(?<![A-Za-z])(?i:" + _NAMES + ")" + _ASSIGN
            + r"""["']?(?=((?<=")[^"\s]+|(?<=')[^'\s]+|(?<!["'])[^"'\s=:>][^"'\s]*))""")
FEATURES = ("length", "runs", "digits", "uppers", "distinct", "vowels", "hex", "rare_steps", "coverage", "slashes",
            "dots", "ats", "marks", "prefixed", "before_credential", "before_assign", "before_path", "before_header",
            "before_digest", "quoted", "after_word", "after_call")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", context: int = 40, least: int = 12,
               least_letters: int = 24) -> DataFrame:
    """(doc_id, nth, token, before, after): every candidate of every whole text,
    cut out with its surroundings; the values of ``named_values`` among them.

    The text is split at the candidates, so each costs a constant number of
    passes over its text; its surroundings are put together again from the pieces
    next to it, other candidates (long credential names, say) among them.
    Candidates have ``least`` characters or more and need a digit, or capitals after
    small letters, or the shape of an access key, or a credential name in front, or
    ``least_letters`` characters.
    """
    pattern = _CANDIDATE % least
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).where(
        F.col("text").rlike(f"[A-Za-z0-9+/_.@-]{{{least}}}"))
    cut = found.select("doc_id", F.regexp_extract_all("text", F.lit(pattern), F.lit(1)).alias("tokens"),
                       F.split("text", pattern).alias("rest"))

    near = -(-context // least)          # so many candidates fill the context

    def surroundings(token: Column, nth: Column) -> Column:
        before = _run(nth - near, nth, "tokens", "rest")
        after = _run(nth + 1, nth + 1 + near, "tokens", "rest")
        return F.struct(nth.alias("nth"), token.alias("token"), F.right(before, F.lit(context)).alias("before"),
                        F.left(after, F.lit(context)).alias("after"))

    def wanted(x: Column) -> Column:
        return (x["token"].rlike("[0-9]") | x["token"].rlike("[a-z][A-Z]") | x["token"].rlike(f"^{ACCESS_KEY}$")
                | named(x["before"]) | (F.length(x["token"]) >= least_letters))

    # only the short surroundings leave the row, never the text
    each = cut.select("doc_id", F.explode(F.filter(F.transform("tokens", surroundings), wanted)).alias("x"))
    return each.select("doc_id", "x.*").where(~assigned(F.col("before"))).unionByName(
        named_values(docs, id_col, text_col, context))


def named_values(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", context: int = 40) -> DataFrame:
    """As ``candidates``: the values right after a credential name and an
    assignment, however short and with any marks; they are numbered from -1 down."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).where(
        F.col("text").rlike("(?i:" + _NAMES + ")" + _ASSIGN))
    cut = found.select("doc_id", F.regexp_extract_all("text", F.lit(ASSIGNED), F.lit(0)).alias("names"),
                       F.regexp_extract_all("text", F.lit(ASSIGNED), F.lit(1)).alias("values"),
                       F.split("text", ASSIGNED).alias("rest"))
    near = -(-context // 4)              # a name and its assignment are 4 characters or more

    def one(value: Column, nth: Column) -> Column:
        before = F.concat(_run(nth - near, nth, "names", "rest"), F.element_at("names", nth + 1))
        follows = _run(nth + 1, nth + 1 + near, "names", "rest")       # starts with the value, which may hold names
        after = F.when(F.startswith(follows, value), F.substr(follows, F.length(value) + 1)).otherwise(F.lit(""))
        return F.struct((-1 - nth).alias("nth"), value.alias("token"), F.right(before, F.lit(context)).alias("before"),
                        F.left(after, F.lit(context)).alias("after"))

    return cut.select("doc_id", F.explode(F.transform("values", one)).alias("x")).select("doc_id", "x.*")


def assigned(before: Column) -> Column:
    """A credential name and an assignment stand right before: what follows is among ``named_values``."""
    return before.rlike(r"(?:^|[^A-Za-z])(?i:" + _NAMES + ")" + _ASSIGN + "[\"']?$")


def _run(low: Column, high: Column, tokens: str, rest: str) -> Column:
    """The text from gap ``low`` to gap ``high``: these gaps and the tokens between
    them (gap k stands before token k)."""
    low = F.greatest(low, F.lit(0))
    high = F.least(high, F.size(rest) - 1)
    each = F.transform(F.sequence(low, F.greatest(low, high)), lambda k: F.concat(
        F.coalesce(F.try_element_at(rest, k + 1), F.lit("")),
        F.when(k < high, F.coalesce(F.try_element_at(tokens, k + 1), F.lit(""))).otherwise("")))
    return F.array_join(each, "")


def named(before: Column) -> Column:
    """A credential name and at most an assignment stand right before."""
    names = "|".join(CREDENTIAL_NAMES)
    return F.lower(before).rlike(rf"(^|[^a-z])({names})[\"']?\s*(=>|:=|={{1,3}}|::?)?\s*[\"']?$")


def _share(col: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(col, f"[^{pattern}]", "")) / F.length(col)


def with_features(found: DataFrame, docs: DataFrame | None, text_col: str = "text", common: int = 3,
                  stats: DataFrame | None = None) -> DataFrame:
    """``found`` with one column per feature.

    Dictionary coverage: share of the token's characters in letter runs that
    occur at least ``common`` times as words of the corpus.  Rare steps: mean
    surprise (bits) of its letter pairs under the corpus' letter pairs.  Both
    statistics are counted over all documents; ``stats`` gives them where they
    have been counted (``word_counts``) already.
    """
    token = F.col("token")
    stats = word_counts(docs, text_col) if stats is None else stats
    pieces = found.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("token"), F.lit("([a-z]{3,})"),
                                                                          F.lit(1)))).alias("word")).distinct()
    known = stats.join(pieces, "word", "left_semi").where(F.col("n") >= common).select("word")
    keyed = found.withColumn("fid", F.xxhash64("doc_id", "nth", "token", "before", "after"))
    distinct = keyed.select("token").distinct()
    covered = (distinct.select("token", F.explode(F.regexp_extract_all(F.lower("token"), F.lit("([a-z]{3,})"),
                                                                       F.lit(1))).alias("word"))
               .join(known, "word").groupBy("token").agg(F.sum(F.length("word")).alias("covered")))
    steps = _letter_pairs(stats)
    odd = (distinct.select("token", F.explode(F.expr(
        "transform(sequence(1, length(token) - 1), i -> lower(substring(token, i, 2)))")).alias("pair"))
        .where(F.col("pair").rlike("^[a-z]{2}$")).join(steps, "pair", "left")
        .groupBy("token").agg(F.avg(F.coalesce("bits", F.lit(16.0))).alias("rare_steps")))
    classes = F.translate(token, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
                          "A" * 26 + "a" * 26 + "0" * 10)
    runs = F.length(F.regexp_replace(classes, r"(.)\1*", "x"))
    before, after = F.lower(F.col("before")), F.col("after")
    return (keyed.join(covered, "token", "left").join(odd, "token", "left")
            .withColumn("length", F.length(token).cast("double"))
            .withColumn("runs", (runs - 1) / F.length(token))
            .withColumn("digits", _share(token, "0-9")).withColumn("uppers", _share(token, "A-Z"))
            .withColumn("distinct", F.size(F.array_distinct(F.split(token, ""))) / F.length(token))
            .withColumn("vowels", _share(F.lower(token), "aeiou")).withColumn("hex", _share(token, "0-9a-f"))
            .withColumn("rare_steps", F.coalesce("rare_steps", F.lit(0.0)))
            .withColumn("coverage", F.coalesce("covered", F.lit(0)) / F.length(token))
            .withColumn("slashes", _share(token, "/")).withColumn("dots", _share(token, "."))
            .withColumn("ats", _share(token, "@")).withColumn("marks", 1 - _share(token, "A-Za-z0-9"))
            .withColumn("prefixed", token.rlike(r"^[A-Za-z]{2,6}([_-][a-z]{0,5}[_-]?)(?=[A-Za-z0-9]*[0-9])[A-Za-z0-9-]{16,}$")
                        .cast("double"))
            .withColumn("before_header", before.rlike(r"(bearer|basic|authorization:)\s+$").cast("double"))
            .withColumn("before_digest", before.rlike(r"(sha-?[0-9]*|md5|commit|hash|digest|etag|integrity|base64)[\s:=\",']*$")
                        .cast("double"))
            .withColumn("before_credential", named(F.col("before")).cast("double"))
            .withColumn("before_assign", before.rlike(r"[=:]\s*[\"']?$").cast("double"))
            .withColumn("before_path", before.rlike(r"(/|\\|https?:|www\.)\S*$").cast("double"))
            .withColumn("quoted", (before.rlike("[\"']$") & after.rlike("^[\"']")).cast("double"))
            .withColumn("after_word", after.rlike(r"^[\"']?\s+\p{L}").cast("double"))
            .withColumn("after_call", after.rlike(r"^[(\[]").cast("double")).drop("covered"))


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all documents, words of 3 letters or more between blanks and marks."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text_col)), r"[^\p{L}]+")).alias("word"))
    return words.where(F.col("word").rlike("^[a-z]{3,30}$")).groupBy("word").agg(F.count("*").alias("n"))


def _letter_pairs(words: DataFrame) -> DataFrame:
    """(pair, bits): surprise of the second letter after the first, from all words (at most 676 rows)."""
    pairs = (words.select("n", F.explode(F.expr(
        "transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))")).alias("pair"))
        .groupBy("pair").agg(F.sum("n").alias("n")))
    first = pairs.groupBy(F.substring("pair", 1, 1).alias("a")).agg(F.sum("n").alias("total"))
    return pairs.join(first, F.substring("pair", 1, 1) == F.col("a")).select(
        "pair", (-F.log2(F.col("n") / F.col("total"))).alias("bits"))


def rule_labels(found: DataFrame) -> DataFrame:
    """What plain rules say of findings; null where they say nothing.  They only
    stand in where no forest can be taught, and the forest is measured against them.

    1: an access key id, or a token of digits and letters (8 characters or more)
    right after a credential name.  0: placeholders, addresses, plain numbers, dates and
    versions, and words without digits that no credential name introduces.
    """
    token = F.col("token")
    address = token.rlike("@") & (~named(F.col("before")) | token.rlike(r"^[^@]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$"))
    plain = token.rlike(r"^[0-9.+_-]+$") | address | F.lower(token).rlike("|".join(PLACEHOLDERS))
    wordy = ~token.rlike("[0-9]") & ~named(F.col("before"))
    secret = token.rlike(f"^{ACCESS_KEY}$") | (
        named(F.col("before")) & token.rlike("[0-9]") & token.rlike("[A-Za-z]") & (F.length(token) >= 8))
    return found.withColumn("label", F.when(plain | wordy, 0).when(secret, 1))


def train(labelled: DataFrame, max_rows: int = 20_000, trees: int = 60, depth: int = 10,
          seed: int = 5) -> RandomForestClassificationModel | None:
    """Forest from findings with features and a 0/1 ``label``; at most ``max_rows``
    of each label teach (those with the smallest hash), different tokens first
    counted once.  None when a label is missing altogether."""
    known = labelled.where("label is not null").dropDuplicates(["token", "label"])
    order = F.xxhash64("token", F.lit(seed))
    rows = stage(known.where("label = 1").orderBy(order, "fid").limit(max_rows)
                 .union(known.where("label = 0").orderBy(order, "fid").limit(max_rows))
                 .select(*FEATURES, F.col("label").cast("double").alias("label")), "findings")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed)
    return forest.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows))


def judged(featured: DataFrame, model: RandomForestClassificationModel) -> DataFrame:
    """``featured`` with the forest's ``score``."""
    return (model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(featured))
            .withColumn("score", vector_to_array("probability")[1]))


def lessons(labelled: DataFrame, docs: DataFrame | None, **options) -> DataFrame:
    """Labelled findings (token, before, after, label) with features; those with a
    null token or label teach nothing, null surroundings are empty ones."""
    rows = labelled.where("token is not null and token <> '' and label is not null").select(
        "token", F.coalesce("before", F.lit("")).alias("before"), F.coalesce("after", F.lit("")).alias("after"), "label")
    return with_features(rows.withColumn("doc_id", F.lit(None).cast("long")).withColumn("nth", F.lit(0)), docs, **options)


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, least: int = 12,
         least_letters: int = 24, **options) -> DataFrame:
    """Every candidate: doc_id, nth, token, before, after, score, is_secret.

    ``labelled`` holds findings of earlier scans (token, before, after, label 0
    or 1); without it the committed ones teach (``findings.labelled_findings``).
    The forest judges all candidates.  Without both labels among the lessons the
    score is what the rules say (``rule_labels``), or 0.5.  Null and empty texts
    have no candidates; repeated rows repeat; other columns are ignored.
    """
    stats = stage(word_counts(docs), "word-counts")
    found = stage(with_features(stage(candidates(docs, least=least, least_letters=least_letters), "candidates"), None,
                                stats=stats), "featured")
    taught = stage(labelled_findings(docs.sparkSession), "labelled") if labelled is None else labelled
    model = train(lessons(taught, None, stats=stats), **options)
    if model is None:
        scored = rule_labels(found).withColumn("score", F.coalesce(F.col("label").cast("double"), F.lit(0.5)))
    else:
        scored = judged(found, model)
    return scored.select("doc_id", "nth", "token", "before", "after", "score",
                         (F.col("score") >= threshold).alias("is_secret"))
