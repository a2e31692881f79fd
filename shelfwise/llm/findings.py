"""Labelled findings that teach the secret scan.

Each template is a place in which a token was found, the kind of token, and
whether such findings are secrets: keys of providers, passwords and tokens in
settings, code and headers on one side; hashes, ids, paths, versions, addresses,
identifiers, placeholders and prose on the other.  The labels belong to the
templates, not to anything the forest measures.  Tokens are drawn from a hash of
the finding's number by SQL functions, so the set is the same everywhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (before, kind of token, least and greatest length, after, label).  A kind "x:..." is that text itself;
# "p...|kind" puts the text p... in front.
TEMPLATES = (
    ("key id ", "pAKIA|upper", 16, 16, " was used", 1), ("aws_access_key_id = ", "pAKIA|upper", 16, 16, "\n", 1),
    ("AWS_SECRET_ACCESS_KEY=", "mixed", 40, 40, "\n", 1), ("aws_secret_access_key: \"", "base64", 40, 40, "\"", 1),
    ("push with ", "pghp_|mixed", 36, 36, " failed", 1), ("https://x-access-token:", "pghp_|mixed", 36, 36, "", 1),
    ("deploy uses ", "pglpat-|mixed", 20, 20, ".", 1), ("SLACK=", "pxoxb-|digits", 24, 30, "\n", 1),
    ("stripe.api_key = '", "psk_live_|mixed", 24, 24, "'", 1), ("the live key ", "psk_live_|mixed", 24, 32, " leaked", 1),
    ("maps key=", "pAIza|mixed", 35, 35, "&", 1), ("npm token ", "pnpm_|mixed", 36, 36, " in log", 1),
    ("failed, ", "pgho_|mixed", 36, 36, " pushed", 1), ("found ", "pghs_|mixed", 36, 36, " in the log", 1),
    ("see ", "psk-|mixed", 40, 48, " here", 1), ("and ", "pxoxp-|digits", 24, 40, " was", 1), ("it is ", "prk_test_|mixed", 24, 24, ",", 1),
    ("Authorization: Bearer ", "mixed", 32, 60, "\n", 1), ("Authorization: Bearer ", "peyJ|base64", 60, 60, "\n", 1),
    ("auth_token: '", "hex", 32, 40, "'", 1), ("access_token=", "mixed", 20, 48, "&", 1),
    ("client_secret = \"", "mixed", 20, 40, "\"", 1), ("client_secret\": \"", "hex", 32, 32, "\",", 1),
    ("password=", "hex", 16, 20, " and", 1), ("password=", "mixed", 8, 16, "\n", 1), ("PASSWORD: ", "marked", 9, 16, "\n", 1),
    ("db_password = '", "marked", 10, 20, "'", 1), ("passwd=", "mixed", 8, 14, ";", 1), ("pwd=", "marked", 8, 12, ";", 1),
    ("api_key=\"", "mixed", 24, 40, "\"", 1), ("apikey: ", "hex", 32, 32, "\n", 1), ("secret => \"", "base64", 32, 44, "\"", 1),
    ("SECRET_KEY = '", "marked", 24, 50, "'", 1), ("token = \"", "mixed", 24, 40, "\"", 1), ("token: ", "base64", 28, 40, "\n", 1),
    ("use ", "mixed", 32, 44, " as the key", 1), ("hunter wrote password: ", "letters", 9, 14, "7!\n", 1),
    ("commit ", "hex", 40, 40, "\n", 0), ("merged at ", "hex", 12, 16, " today", 0), ("sha256:", "hex", 64, 64, " ", 0),
    ("md5 ", "hex", 32, 32, "  file", 0), ("integrity=\"", "psha512-|base64", 60, 60, "\"", 0), ("ETag: \"", "hex", 32, 32, "\"", 0),
    ("id ", "uuid", 36, 36, " was", 0), ("request ", "uuid", 36, 36, "\n", 0), ("?session_ref=", "uuid", 36, 36, "&", 0),
    ("see ", "path", 20, 40, " for", 0), ("/usr/share/", "path", 14, 30, " is", 0), ("import ", "dotted", 14, 34, "\n", 0),
    ("https://", "host", 14, 30, "/ ", 0), ("write to ", "address", 14, 30, " or", 0), ("from ", "address", 14, 30, ",", 0),
    ("version ", "version", 12, 16, " of", 0), ("on ", "date", 12, 20, " the", 0), ("number ", "digits", 12, 18, " ", 0),
    ("call ", "camel", 12, 26, "(", 0), ("the ", "camel", 12, 26, " class", 0), ("field ", "snake", 12, 26, " of", 0),
    ("part ", "serial", 12, 18, " in", 0), ("see build ", "serial", 12, 16, " here", 0), ("order ", "serial", 12, 16, ",", 0),
    ("png;base64,", "base64", 40, 60, "", 0), ("color ", "hex", 12, 12, " ", 0), ("trace ", "hex", 16, 32, " span", 0),
    ("the word ", "letters", 24, 36, " is", 0), ("a ", "letters", 24, 30, " of", 0),
    ("password=", "x:changeme", 0, 0, "\n", 0), ("password=", "x:changeable1", 0, 0, " in docs", 0),
    ("password: ", "x:your_password_here", 0, 0, "\n", 0), ("password=", "x:${DB_PASSWORD}", 0, 0, "\n", 0),
    ("password = ", "x:getpass.getpass()", 0, 0, "\n", 0), ("password=", "x:********", 0, 0, " ", 0),
    ("token: ", "x:see2section4", 0, 0, " below", 0), ("token=", "x:None", 0, 0, ",", 0), ("token: ", "x:string", 0, 0, "\n", 0),
    ("token = ", "camel", 8, 20, "(", 0), ("secret=", "x:<your-secret-key>", 0, 0, " ", 0), ("secret: ", "x:example1234", 0, 0, "\n", 0),
    ("auth: ", "x:required", 0, 0, "\n", 0), ("auth=", "x:true", 0, 0, "&", 0), ("pwd=", "path", 10, 24, "\n", 0),
    ("api_key = os.environ[\"", "snake", 8, 16, "\"", 0), ("api_key: ", "x:YOUR_API_KEY_1", 0, 0, "\n", 0),
    ("the password ", "letters", 5, 9, " must be", 0), ("password: ", "letters", 5, 10, " it carefully", 0),
    ("secret: ", "dotted", 12, 24, "\n", 0), ("token=", "x:test1234", 0, 0, "\n", 0), ("passwd: ", "x:xxxxxxxx1", 0, 0, "\n", 0),
    ("password reset id ", "uuid", 36, 36, " sent", 0), ("apikey=", "x:placeholder0", 0, 0, "&", 0),
)
WORDS = ("user", "order", "file", "main", "config", "handler", "value", "parse", "index", "report", "server", "client",
         "total", "item", "build", "test", "page", "data", "cache", "event")


def _drawn(kind: str, size: Column, seed: Column) -> Column:
    """A token of ``kind``, about ``size`` characters, from a text ``seed``."""
    def digest(k):
        return F.sha2(F.concat(seed, F.lit(k)), 256)

    hexes = F.concat(digest("a"), digest("b"))
    base64 = F.concat(*[F.regexp_replace(F.base64(F.unhex(digest(k))), "=", "") for k in "cde"])
    mixed = F.translate(base64, "+/", "")
    letters = F.translate(hexes, "0123456789", "ghijklmnop")
    digits = F.translate(hexes, "abcdef", "123456")
    word = F.array(*[F.lit(w) for w in WORDS])

    def nth(k):
        return F.element_at(word, (F.pmod(F.xxhash64(seed, F.lit(k)), F.lit(len(WORDS))) + 1).cast("int"))

    def cut(c):
        return F.substring(c, F.lit(1), size)
    words = [nth(k) for k in range(5)]
    number = F.substring(digits, 1, 2)
    made = {
        "hex": cut(hexes), "mixed": cut(mixed), "base64": cut(base64), "upper": cut(F.upper(mixed)),
        "letters": cut(letters), "digits": cut(digits),
        "marked": F.concat(cut(F.substring(mixed, F.lit(1), size - 3)), F.element_at(
            F.array(*[F.lit(m) for m in ("!x7", "@9k", "#Q2", "$p4", "&3Z", "%w8")]),
            (F.pmod(F.xxhash64(seed), F.lit(6)) + 1).cast("int"))),
        "uuid": F.concat_ws("-", *[F.substring(hexes, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
        "path": F.concat(F.concat_ws("/", *words[:4]), number, F.lit(".py")),
        "dotted": F.concat(F.concat_ws(".", *words[:4]), number),
        "host": F.concat(words[0], number, F.lit("."), words[1], F.lit(".example-"), words[2], F.lit(".com")),
        "address": F.concat(words[0], F.lit("."), words[1], number, F.lit("@"), words[2], F.lit("mail.org")),
        "version": F.concat_ws(".", F.substring(digits, 1, 2), F.substring(digits, 3, 2), F.substring(digits, 5, 3),
                               F.concat(F.lit("rc"), F.substring(digits, 8, 2))),
        "date": F.concat(F.lit("20"), number, F.lit("-0"), F.substring(digits, 4, 1), F.lit("-1"), F.substring(digits, 5, 1),
                         F.lit("T0"), F.substring(digits, 6, 1)),
        "camel": F.concat(words[0], *[F.initcap(w) for w in words[1:4]], F.substring(digits, 1, 1)),
        "snake": F.concat(F.concat_ws("_", *words[:3]), F.lit("_"), F.substring(digits, 1, 1)),
        "serial": F.concat(words[0], F.lit("-"), F.substring(digits, 1, 6), F.lit("-"), F.substring(letters, 1, 2)),
    }
    return made[kind]


def _kind(written: str) -> tuple[str, str]:
    """(prefix, kind) of a template's second entry; kind "x" is the prefix alone."""
    if written.startswith("x:"):
        return written[2:], "x"
    if "|" in written:
        prefix, kind = written.rsplit("|", 1)
        return prefix[1:], kind
    return "", written


def labelled_findings(spark: SparkSession, each: int = 40) -> DataFrame:
    """(template, token, before, after, label): ``each`` findings of every template
    (one of those whose token is a text)."""
    names = ("template", "before", "prefix", "kind", "low", "high", "after", "label")
    rows = [(i, before, *_kind(kind), *rest) for i, (before, kind, *rest) in enumerate(TEMPLATES)]
    # literals of the plan: no Python row has to be read on an executor
    table = spark.range(1).select(F.explode(F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows])).alias("t")).select("t.*")
    numbered = table.withColumn("n", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == "x", 1).otherwise(each))))
    seed = F.concat_ws("/", F.col("template").cast("string"), F.col("n").cast("string"))
    size = F.col("low") + F.pmod(F.xxhash64(seed), F.col("high") - F.col("low") + 1).cast("int")
    prefix = F.when(F.col("prefix") != "", F.col("prefix")).otherwise(F.lit(""))
    parts = [numbered.where(F.col("kind") == kind).select(
        "template", F.concat(prefix, _drawn(kind, size, seed) if kind != "x" else F.lit("")).alias("token"), "before", "after",
        "label") for kind in sorted({_kind(t[1])[1] for t in TEMPLATES})]
    return reduce(DataFrame.unionAll, parts)
