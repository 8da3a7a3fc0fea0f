from random import Random

from pyspark.sql import functions as F

from urbanflux.llm import quality

CLEAN = "The committee met on Tuesday to discuss the new library building and its cost. Several members asked how long the work would take, and the architect answered that two years seemed likely."
ROWS = [
    (1, CLEAN, "en"),
    (2, "word " * 40, "en"),
    (3, "too few words", "en"),
    (4, "zq" + " ".join(chr(0x1E00 + i) * 3 for i in range(60)), "en"),
    (5, "\n".join(["same line here"] * 3 + ["", " ", "other line"] + [CLEAN]), None),
    (6, "a|b # $ % & * < > |||", "xx"),
    (7, "", "en"),
    (8, None, None),
    (9, " \t\n\r\x0b\x0c ", "en"),
    (10, CLEAN.replace(" ", " "), "en"),
    (11, (CLEAN + " ") * 300, "en"),
    (12, "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 1 + "Комиссия обсудила новое здание библиотеки, его стоимость и сроки работ в городе.", None),
    (13, CLEAN, "zz"),
]


def plain(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    repeated = set()
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in places.values():
        if len(at) > 1:
            repeated.update(j for i in at for j in range(i, i + 8))
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), failed


def test_base_counts_like_the_definitions(documents):
    for r in quality.judge_quality(documents(*ROWS)).collect():
        want = plain(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want, r["doc_id"]
        assert not (r["kept"] and r["base_failed"])


def test_bands_keep_prose_and_reject_what_the_vocabulary_cannot_spell(documents):
    found = {r["doc_id"]: r for r in quality.judge_quality(documents(*ROWS)).collect()}
    assert found[1]["kept"] and found[12]["kept"] and found[13]["kept"]
    assert not found[4]["base_failed"] and not found[4]["kept"]
    assert found[12]["band"] == "CYRILLIC" and found[13]["band"] == "LATIN" and found[1]["band"] == "en"
    assert found[4]["fallback_share"] > 0.3 > found[1]["fallback_share"]
    assert found[1]["chars_per_token"] > 3
    strict = quality.judge_quality(documents(*ROWS), languages={"en": quality.Band(99, 100, 0, 0)})
    assert not strict.where("doc_id = 1").first()["kept"]


def test_low_entropy_is_rejected(documents):
    random = Random(1)
    text = " ".join("ha" * random.randrange(1, 90) for _ in range(300))
    row = quality.judge_quality(documents((1, text, "en"))).first()
    assert not row["base_failed"] and row["token_entropy"] < 0.4 and not row["kept"]


def test_repeats_clashing_columns_and_empty_table(documents):
    df = documents(ROWS[0], ROWS[0], (None, None)).withColumn("kept", F.lit("clash")).withColumn("band", F.lit(1))
    found = quality.judge_quality(df).collect()
    assert sorted(r["kept"] for r in found) == [False, True, True]
    assert quality.judge_quality(df.limit(0)).collect() == []


def test_decorated_and_junk_documents_of_a_given_table_fall_outside_while_clean_prose_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = quality.judge_quality(docs).where("NOT base_failed")
    share = F.col("n_symbols") / F.col("word_chars")
    # the table's marks are * and # on words, or bars between them
    found = {r["k"]: r for r in judged.groupBy(F.when(share > 0.08, "junk").when(share == 0, "clean").alias("k")).agg(
        F.count("*").alias("n"), F.avg(F.col("kept").cast("int")).alias("kept"))
        .collect()}
    assert found["junk"]["n"] > 30 and found["junk"]["kept"] < 0.4
    assert found["clean"]["n"] > 500 and found["clean"]["kept"] > 0.95
