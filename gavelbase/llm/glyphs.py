"""Visually identical text with different characters: bring all texts to one form in which they compare equal.

Method: a text is exploded to positioned code points; a broadcast table gives each its decomposition with look-alike letters
mapped to one; combining marks are ordered by class, letter and mark are recomposed, and the string is rebuilt in order.
Runs of code points that stand for themselves stay in one piece; only a cluster that holds another code point, or a mark, is
exploded. All code points of the text take part.

The texts are brought to the tasks by a hash of their id before the explosion, so pieces are put together again without
another shuffle. The tables of decompositions, marks and compositions are built by rule from the whole Unicode database, the
look-alike letters from the public table of confusable characters; their size is fixed by these.

Defined results: a null text stays null, an empty one empty; invisible characters vanish, every kind of space becomes U+0020;
letter case, line feeds, punctuation other than its width, superscripts and circled signs are kept; rows of equal id and text
come out once, those of equal id and another text each. Hangul syllables come out decomposed.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelbase.session import checkpoint

#: Letters of other scripts that look like a Latin letter, in pairs of strings.
CYRILLIC = ("АВЕЅІЈКМНОРСТУХЗаеорсухіјѕԁԛԝһ", "ABESIJKMHOPCTYX3aeopcyxijsdqwh")
GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανικρυγ", "ABEZHIKMNOPTYXoavikpuy")
#: Dashes and signs that differ in code but not in shape.
SIGNS = ("‐‑−ꞏ‧∙ꓸ∕⁄‚ⅼⅠ", "---···.//,lI")
#: Code points that show nothing.
INVISIBLE = [0xAD, 0x34F, 0x61C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), 0x3164, *range(0xFE00, 0xFE10), 0xFEFF, 0xFFA0, *range(0xE0000, 0xE0080), *range(0xE0100, 0xE01F0)]
#: What stands for itself and needs no table: ASCII, the basic Han block, and Chinese marks without another form.
INERT = "\\u0000-\\u007f\\u4e00-\\u9fff\\u3001\\u3002\\u3010\\u3011\\u3014\\u3015\\u300a\\u300b\\u201c\\u201d\\u2018\\u2019\\u2030"
_KINDS = ("", "<wide>", "<narrow>", "<noBreak>", "<font>")


def _alike() -> dict[str, str]:
    out: dict[str, str] = {}
    for a, b in (CYRILLIC, GREEK, SIGNS):
        assert len(a) == len(b), (a, b)
        out |= dict(zip(a, b))
    return out


def _public_alike(spark: SparkSession) -> dict[str, str]:
    """Letters outside ASCII that the public table of confusable characters (as shipped with Spark's ICU) gives the skeleton of one ASCII letter.

    A skeleton is shared by I, l and 1 or by O and 0; the letter's case tells which is meant.
    """
    letters = [chr(k) for k in range(0x80, 0x20000) if not (0x2E80 <= k < 0xA4D0 or 0xAC00 <= k < 0xE000 or 0xF900 <= k < 0xFB00) and unicodedata.category(chr(k)) in ("Lu", "Ll", "Lo", "Lm")]
    checker = spark._jvm.com.ibm.icu.text.SpoofChecker
    made = getattr(spark._jvm.com.ibm.icu.text, "SpoofChecker$Builder")().setChecks(checker.CONFUSABLE).build()
    skeletons = made.getSkeleton("\n".join(letters)).split("\n")
    out = {}
    for c, k in zip(letters, skeletons):
        if len(k) == 1 and k.isascii() and k.isalpha():
            upper = unicodedata.category(c) == "Lu"
            out[c] = "I" if k == "l" and upper else k
    return out


#: Tables by the look-alike letters they are made with.
_MADE: dict[int, dict[str, str]] = {}


def decompositions(spark: SparkSession | None = None) -> dict[str, str]:
    """Code point to what it is decomposed and mapped to; only those that change. All of Unicode; with a session the public look-alikes as well."""
    which = 0 if spark is None else 1
    if which not in _MADE:
        _MADE[which] = _decompositions({**(_public_alike(spark) if spark else {}), **_alike()})
    return _MADE[which]


def _decompositions(alike: dict[str, str]) -> dict[str, str]:
    hidden = set(INVISIBLE)

    def expand(c: str) -> str:
        if ord(c) in hidden:
            return ""
        if unicodedata.category(c) == "Zs":
            return " "
        if 0xAC00 <= ord(c) < 0xD7A4:
            return unicodedata.normalize("NFD", c)
        d = unicodedata.decomposition(c)
        kind, _, rest = d.partition("> ") if d.startswith("<") else ("", "", d)
        kind = kind + ">" if kind else ""
        ligature = 0xFB00 <= ord(c) <= 0xFB06 or 0x2E80 <= ord(c) <= 0x2FDF
        if c not in alike and d and (kind in _KINDS or ligature):
            return "".join(expand(chr(int(x, 16))) for x in rest.split())
        return alike.get(c, c)

    out = {}
    for k in range(0x80, 0x110000):
        c = chr(k)
        if (0x3400 <= k < 0xA000 or 0xE000 <= k < 0xF900 or 0x20000 <= k < 0x2F800 or k >= 0x30000) and k not in hidden or 0xD800 <= k < 0xE000:
            continue  # Han without another form, private and unused planes
        if (e := expand(c)) != c:
            out[c] = e
    return out


@cache
def compositions() -> dict[str, str]:
    """Letter and mark to the letter with the mark."""
    out = {}
    for k in [*range(0x80, 0x3400), *range(0xA000, 0xAC00), *range(0xFB00, 0xFE00), *range(0x10000, 0x1F000)]:
        d = unicodedata.decomposition(chr(k)).split()
        if len(d) == 2 and not d[0].startswith("<") and unicodedata.combining(chr(int(d[1], 16))) and unicodedata.normalize("NFC", chr(k)) == chr(k):
            out[chr(int(d[0], 16)) + chr(int(d[1], 16))] = chr(k)
    return out


@cache
def marks() -> dict[str, int]:
    """All code points with a combining class, and it."""
    return {chr(k): c for k in range(0x300, 0x1F000) if not 0xD800 <= k < 0xE000 and (c := unicodedata.combining(chr(k)))}


def canonical_text(text: str | None, table: dict[str, str] | None = None) -> str | None:
    """The same form for one string, for tests and small inputs."""
    if text is None:
        return None
    table = decompositions() if table is None else table
    s = "".join(table.get(c, c) for c in text)
    if not any(unicodedata.combining(c) for c in s):
        return s
    s = unicodedata.normalize("NFC", unicodedata.normalize("NFD", s))
    return "".join(unicodedata.normalize("NFD", c) if "\uac00" <= c <= "\ud7a3" else c for c in s)


def _table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(decompositions(spark).items()), "cp string, mapped string")


def _map(pairs: dict) -> Column:
    return F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))


def _parted(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """_id, _text and _h of the texts that hold other than inert code points, and of the rest."""
    own = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text")).withColumn("_h", F.xxhash64("_text"))
    active = F.coalesce(F.col("_text").rlike(f"[^{INERT}]"), F.lit(False))
    return own.where(active), own.where(~active)


def _rebuilt(active: DataFrame) -> DataFrame:
    table = _table(active.sparkSession)
    active = active.repartition("_id").dropDuplicates(["_id", "_h"])  # what follows is grouped by id without another shuffle
    # pieces: a run of inert code points that no mark follows, or one code point with its marks; the text itself is left behind
    pieces = F.expr(f"regexp_extract_all(_text, '(?s)([{INERT}]+(?![\\\\p{{M}}])|.[\\\\p{{M}}]*)', 1)")
    piece = active.select("_id", "_h", F.posexplode(pieces).alias("at", "piece"))
    inert = F.col("piece").rlike(f"^[{INERT}]*$")
    points = piece.select("_id", "_h", "at", F.posexplode(F.when(inert, F.array("piece")).otherwise(F.split("piece", ""))).alias("k", "cp"))
    mapped = points.join(F.broadcast(table), "cp", "left").select("_id", "_h", "at", "k", F.coalesce("mapped", "cp").alias("cp"))
    rebuilt = F.transform(F.array_sort(F.collect_list(F.struct("at", "k", "cp"))), lambda x: x["cp"])
    joined = mapped.groupBy("_id", "_h").agg(F.array_join(rebuilt, "").alias("_d"))
    composed = _compose(F.col("_d"), marks())
    return joined.select("_id", "_h", F.when(F.col("_d").rlike("\\p{M}"), composed).otherwise(F.col("_d")).alias("canonical"))


def same_form(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, the stored text's hash ``_h`` and its canonical form ``canonical`` of each different row."""
    active, plain = _parted(df, id_col, text_col)
    return plain.dropDuplicates(["_id", "_h"]).select("_id", "_h", F.col("_text").alias("canonical")).unionByName(_rebuilt(active))


def form_hashes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, t (the stored text) and h (its canonical form) as hashes, each different row once. Texts that stand as they are aren't shuffled."""
    active, plain = _parted(df, id_col, text_col)
    of_plain = plain.where("_text is not null").select(F.col("_id").alias("id"), F.col("_h").alias("t"), F.sha2("_text", 256).alias("h")).distinct()
    return checkpoint(of_plain.unionByName(_rebuilt(active).select(F.col("_id").alias("id"), F.col("_h").alias("t"), F.sha2("canonical", 256).alias("h"))))


def form_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, class_id (the smallest id of the form), texts (different stored texts of the form) and rows, of each row whose form has several stored texts."""
    forms = form_hashes(df, id_col, text_col)
    whole = forms.groupBy("h", "t").agg(F.min("id").alias("low"), F.count("*").alias("n")).groupBy("h").agg(F.min("low").alias("class_id"), F.count("*").alias("texts"), F.sum("n").alias("rows")).where("texts > 1")
    return forms.join(whole, "h").select("id", "class_id", "texts", "rows")


def _compose(text: Column, classes: dict[str, int]) -> Column:
    """Clusters of a letter and marks: marks ordered by class, then letter and marks recomposed."""
    order, pairs = _map(classes), _map(compositions())
    clusters = F.regexp_extract_all(text, F.lit("(?s)([^\\p{M}]?\\p{M}+|[^\\p{M}]+(?!\\p{M}))"), 1)

    def one(cluster: Column) -> Column:
        chars = F.split(cluster, "")
        tail = F.array_sort(
            F.transform(F.slice(chars, 2, F.greatest(F.size(chars) - 1, F.lit(0))), lambda m, i: F.struct(F.coalesce(F.try_element_at(order, m), F.lit(0)).alias("c"), i.alias("i"), m.alias("m")))
        )
        start = F.struct(F.element_at(chars, 1).alias("base"), F.lit("").alias("rest"), F.lit(0).alias("blocked"))

        def step(acc: Column, x: Column) -> Column:
            to = F.try_element_at(pairs, F.concat(acc["base"], x["m"]))
            ok = to.isNotNull() & (acc["blocked"] < x["c"])
            return F.struct(F.when(ok, to).otherwise(acc["base"]).alias("base"), F.when(ok, acc["rest"]).otherwise(F.concat(acc["rest"], x["m"])).alias("rest"), F.when(ok, acc["blocked"]).otherwise(x["c"]).alias("blocked"))

        return F.when(cluster.rlike("\\p{M}"), F.aggregate(tail, start, step, lambda a: F.concat(a["base"], a["rest"]))).otherwise(cluster)

    return F.array_join(F.transform(clusters, one), "")


def look_alikes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs of rows whose texts differ as stored but have one canonical form: id_a < id_b.

    Texts are grouped by the hash of their form and, within it, by stored text; pairs join rows of different stored texts only,
    and forms with a single stored text are left out before the join.
    """
    forms = form_hashes(df, id_col, text_col)
    several = forms.groupBy("h").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo <> hi").select("h")
    rows = forms.join(several, "h")
    texts = rows.select("h", "t").distinct()
    # different texts of a form meet first, then the rows of each, so that copies of one text never meet one another
    met = texts.withColumnRenamed("t", "ta").join(texts.withColumnRenamed("t", "tb"), "h").where("ta < tb")
    left = met.join(rows.select("h", F.col("t").alias("ta"), F.col("id").alias("ia")), ["h", "ta"])
    both = left.join(rows.select("h", F.col("t").alias("tb"), F.col("id").alias("ib")), ["h", "tb"])
    return both.where("ia <> ib").select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b"))
