"""Files in unknown encodings as text: the charset is told from the bytes, and decoded by built-in functions.

A single-byte charset is a table of 128 characters, so its text is the Latin-1
reading with those characters put in their place. Nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_HIGH = "".join(map(chr, range(0x80, 0x100)))
WESTERN = "windows-1252"
CYRILLIC = ("windows-1251", "koi8-r", "cp866", "iso8859-5")
# Frequent pairs of letters in Russian.
PAIRS = "ст но то на ен ов ни ра во ко ал ли по ре ос пр не ро го та от ка ан ер ло ор ва ет ол те ны ль ия ие ит ис"
_COMMON = "(?=" + "|".join(PAIRS.split()) + ")"
_TURNED = "[а-яё](?=[А-ЯЁ])"
# Letters beyond ASCII of one language each, and marks that go with any.
LETTERS = ("àâæçèéêëîïôùûüÿœ", "äöüß", "áéíñóúü")
_MARKS = "\xa0¡¿«»°"


def table(charset: str) -> str:
    """The characters of a single-byte charset's upper 128 bytes; bytes without one give U+FFFD."""
    return "".join(bytes([b]).decode(charset, "replace") for b in range(0x80, 0x100))


def _latin(content: Column) -> Column:
    """A character for each byte."""
    return F.decode(content, "ISO-8859-1")


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def single(content: Column, charset: str) -> Column:
    return F.translate(_latin(content), _HIGH, table(charset))


def as_single(text: Column, charset: str) -> Column:
    """The bytes of a text all of whose characters the charset has."""
    return F.encode(F.translate(text, table(charset), _HIGH), "ISO-8859-1")


def _wide(content: Column, charset: str) -> Column:
    """UTF-16 without halves of surrogate pairs and without a last odd byte, which have no character."""
    low, high, any_ = ("[\\xD8-\\xDB]", "[\\xDC-\\xDF]", "[^\\xD8-\\xDF]")
    pair, plain = (f".{low}.{high}", f".{any_}") if charset == "UTF-16LE" else (f"{low}.{high}.", f"{any_}.")
    whole = F.regexp_replace(_latin(content), f"(?s)({pair})|({plain})|..?", "$1$2")
    return F.decode(F.encode(whole, "ISO-8859-1"), charset)


def _russian(text: Column) -> Column:
    """How Russian a reading looks: frequent pairs of letters, less capitals that follow small letters."""
    return F.regexp_count(F.lower(text), F.lit(_COMMON)) - 2 * F.regexp_count(text, F.lit(_TURNED))


def charset(content: Column) -> Column:
    """The charset of binary content: its byte order mark's, else told from all of its bytes; null for null.

    UTF-16 without a mark: even length, and at least three of five bytes at one
    parity are 0 or 4 (the high bytes of Latin and Cyrillic letters), twice as
    many as at the other. Else UTF-8 if the bytes are valid as such (empty
    content too). Else a single-byte charset: Western where ASCII letters are
    no fewer than upper bytes, or where all of these are letters of one Western
    language and no Cyrillic reading has a frequent pair of Russian letters for
    each five of them (a word or two, such as "Éé"); otherwise the Cyrillic one
    that gives the most such pairs, the first of CYRILLIC on a tie.
    """
    mark = F.hex(F.substring(content, 1, 3))
    latin = _latin(content)
    size = F.length(content)
    few = _count(latin, "\x00\x04") * 10 >= size * 3
    at = lambda k: _count(F.regexp_replace(latin, "(?s)(.)(.)", f"${k}"), "\x00\x04")
    wide = lambda one, other: (size % 2 == 0) & (size > 0) & few & (at(one) * 10 >= size * 3) & (at(one) >= 2 * at(other))
    high = F.length(F.regexp_replace(latin, "[\\x00-\\x7F]+", ""))
    letters = F.length(F.regexp_replace(latin, "[^A-Za-z]+", ""))
    ranked = F.array(*(F.struct((-_russian(single(content, c))).alias("least"), F.lit(k).alias("k"), F.lit(c).alias("charset")) for k, c in enumerate(CYRILLIC)))
    best = F.array_min(ranked)
    western = single(content, WESTERN).rlike("|".join(f"^[\\x00-\\x7F{_MARKS}{own}{own.upper().replace('SS', '')}]*$" for own in LETTERS))
    return (
        F.when(content.isNull(), None)
        .when(mark.startswith("EFBBBF"), "UTF-8")
        .when(mark.startswith("FFFE"), "UTF-16LE")
        .when(mark.startswith("FEFF"), "UTF-16BE")
        .when(wide(2, 1), "UTF-16LE")
        .when(wide(1, 2), "UTF-16BE")
        .when(F.is_valid_utf8(content.cast("string")), "UTF-8")
        .when(letters >= high, WESTERN)
        .when(western & (best["least"] * -5 < high), WESTERN)
        .otherwise(best["charset"])
    )


def text(content: Column, charset: Column) -> Column:
    """Content read by its charset, without a byte order mark and white space around; invalid UTF-8 gives U+FFFD."""
    out = F.when(charset == "UTF-8", F.make_valid_utf8(content.cast("string")))
    for c in ("UTF-16LE", "UTF-16BE"):
        out = out.when(charset == c, _wide(content, c))
    for c in (WESTERN, *CYRILLIC):
        out = out.when(charset == c, single(content, c))
    return F.regexp_replace(F.regexp_replace(out, "^\ufeff", ""), r"(?U)^\s+|\s+$", "")


def decoded(files: DataFrame, content: str = "content") -> DataFrame:
    """files with charset and text of their binary column; null content has neither."""
    return files.withColumn("charset", charset(F.col(content))).withColumn("text", text(F.col(content), F.col("charset")))


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """(name, charset, text) of the files of a path or pattern, each whole."""
    files = spark.read.format("binaryFile").load(path)
    return decoded(files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")).drop("content")
