"""Files in several encodings give one table of texts."""

import duckdb
import pytest
from pyspark.sql import functions as F

from factloom import catalogue
from factloom.sources import charsets, tables

RUSSIAN = "Пациент, 54 года, поступил в стационар.\nАллергоанамнез не отягощён. Гемоглобин 118 г/л, АД 120/80 мм рт. ст."
SHORT = "Жалобы на боли в сердце"
LOUD = "ВЫПИСКА ИЗ ИСТОРИИ БОЛЕЗНИ: СОСТОЯНИЕ УДОВЛЕТВОРИТЕЛЬНОЕ"
FRENCH = "Le patient a été opéré à Besançon, où la fièvre a cédé."


def seen(spark, *contents):
    rows = charsets.decoded(spark.createDataFrame([(k, c) for k, c in enumerate(contents)], "k int, content binary"))
    return [(r.charset, r.text) for r in rows.orderBy("k").collect()]


@pytest.mark.parametrize("written", [RUSSIAN, SHORT, LOUD, RUSSIAN * 500])
def test_russian_in_every_charset(spark, written):
    names = {"UTF-8": "utf-8", "UTF-16LE": "utf-16-le", "UTF-16BE": "utf-16-be"} | {c: c for c in charsets.CYRILLIC}
    found = seen(spark, *(bytearray(written.encode(codec, "strict")) for codec in names.values()))
    assert found == [(name, written) for name in names]


def test_marks_latin_texts_and_what_has_no_character(spark):
    cases = [
        ("\ufeffa".encode(), ("UTF-8", "a")),
        ("\ufeff нет ".encode("utf-16-le"), ("UTF-16LE", "нет")),
        ("\ufeffabc".encode("utf-16-be"), ("UTF-16BE", "abc")),
        ("plain text".encode("utf-16-le"), ("UTF-16LE", "plain text")),
        (FRENCH.encode("cp1252"), ("windows-1252", FRENCH)),
        (FRENCH.encode(), ("UTF-8", FRENCH)),
        (b"", ("UTF-8", "")),
        (None, (None, None)),
        (b"\xff\xfea\x00\x00\xd8b\x00\x3d\xd8\x00\xdec", ("UTF-16LE", "ab\U0001f600")),  # half a pair, a pair, an odd byte
        (b"\xef\xbb\xbfa\xff", ("UTF-8", "a�")),
        (b" \t\n ", ("UTF-8", "")),
        ("x" .encode(), ("UTF-8", "x")),
    ]
    assert seen(spark, *(None if c is None else bytearray(c) for c, _ in cases)) == [want for _, want in cases]


def test_bytes_of_a_text_and_back(spark):
    rows = spark.createDataFrame([(RUSSIAN,)], "t string")
    for c in charsets.CYRILLIC:
        (row,) = rows.select(charsets.as_single(F.col("t"), c).alias("b")).collect()
        assert bytes(row.b) == RUSSIAN.encode(c)


def test_a_folder_in_five_encodings_gives_one_table(spark, tmp_path):
    codecs = ("utf-8-sig", "cp1251", "koi8-r", "utf-16", "cp866")
    for k, codec in enumerate(codecs):
        (tmp_path / f"text{k}_source.txt").write_bytes(f"{RUSSIAN} {k}\n".encode(codec))
        (tmp_path / f"text{k}_model{k + 1}.txt").write_bytes(f"{SHORT} {k}".encode(codecs[-1 - k]))
    rows = {r.emr_id: (r.model_id, r.source_text, r.summary_text) for r in tables.text_pairs(spark, str(tmp_path)).collect()}
    assert rows == {str(k): (tables.MODELS[str(k + 1)], f"{RUSSIAN} {k}", f"{SHORT} {k}") for k in range(5)}


@pytest.mark.parametrize("written", ["Éé.", "À.", "Öä ß.", "ñó ññ", "éç. Èê éé", "«É»", "été"])
def test_a_few_words_of_accented_letters_are_western(spark, written):
    assert seen(spark, bytearray(written.encode("cp1252"))) == [("windows-1252", written)]


def test_short_documents_give_the_rows_of_the_sql(spark, tmp_path):
    texts = ["Éé.", "À.", "Öä ß.", "ñó ññ", "A.", "", None, RUSSIAN, "Éaux."]
    spark.createDataFrame([(3 * k + r, t) for k, t in enumerate(texts) for r in range(3)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = con.sql(f"SELECT doc_id, charset, text_md5 FROM ({catalogue.ORACLE_SQL['document_charsets']})").fetchall()
    assert sorted(map(tuple, catalogue.QUERIES["document_charsets"](spark, str(tmp_path)).collect())) == sorted(expected)
