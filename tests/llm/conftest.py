import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_lines long, score double, sequence_id long, part int, key string, kind int"


def rows():
    """Documents with nulls, empty and long texts, ties, repeated rows and copies."""
    rng = random.Random(5)
    syllables = {"en": "the ing tion er and ou st re".split(), "de": "sch ein ung ver ich keit ge zu".split()}
    word = lambda lang: "".join(rng.choices(syllables[lang], k=rng.randint(1, 4)))
    text = lambda lang, n: " ".join(word(lang) for _ in range(n))
    passage, line = text("en", 70), "  A line that is in MANY documents of this table "
    out = []
    for i in range(60):
        lang = ("en", "de")[i % 2]
        body = text(lang, rng.randint(5, 120))
        if i % 5 == 0:
            body += "\n" + line + "\n" + text(lang, 8)
        if i % 7 == 0:
            body = text(lang, 9) + " " + passage + " " + body
        out.append((i, body, lang))
    out += [(60, None, "en"), (61, "", "en"), (62, " \n\t ", None), (63, "12 34 !!", "de"), (64, out[3][1], "de"), (65, out[3][1] + " end", "de"), (66, "x" * 900, None), (67, "ab " * 400, "en"), (68, text("en", 30_000), "en")]
    out += [out[1], out[1], (None, out[2][1], "en"), (None, None, None), (70, "Ünïcode Straße\u2003日本語  double  spaces \n\n tail ", "de"), (71, "é" * 25 + "\n" + "é" * 25, None), (72, "one", "en")]
    return [(d, t, lang, "s", len(t or ""), 1, 2.0, 3, 4, "k", 5) for d, t, lang in out]


@pytest.fixture(scope="session")
def data():
    return rows()


@pytest.fixture(scope="session")
def docs(spark, data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
