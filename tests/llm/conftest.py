import hashlib
import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0d]+")
DDL = "doc_id long, text string, lang string, source string, n_chars long"


def words(text, lower=False):
    raw = (text or "").encode()
    return [w.decode() for w in (raw.lower() if lower else raw).split()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def corpus():
    """Small documents with everything that is odd: nulls, blanks, copies, near copies, shared passages, one long text."""
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choice(["an", "er", "on", "th", "é", "st", "ing", "ou"]) for _ in range(rnd.randint(1, 4))) for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passage = text(60)
    rows = []
    for i in range(40):
        rows.append([i, f"{text(rnd.randint(20, 200))}.\n{text(30)}", "en", f"s{i % 4}"])
    for i in range(40, 52):  # copies and near copies of earlier ones
        base = rows[i - 40][1]
        parts = base.split(" ")
        if i % 3:
            parts[len(parts) // 2] = f"changed{i}"
        rows.append([i, " ".join(parts), "en", "s0"])
    for i in range(52, 60):
        rows.append([i, f"{text(40)} {passage} {text(i)}", "de", "hot"])
    rows += [[60, None, None, None], [61, "", "", ""], [62, " \t\n", "en", "s1"], [63, "one", "en", "s1"], [64, "One  two\tTHREE four", "en", None], [65, "one two three four", None, "s2"]]
    rows.append([66, text(6000), "en", "s3"])
    rows.append([66, rows[0][1], "en", "s3"])  # an id twice, with another text
    rows.append(list(rows[5]))  # a whole row twice
    rows.append([None, rows[1][1], "en", "s1"])
    rows.append([67, "\n".join(["same line of seven words stands here"] * 30), "en", "s1"])
    rows.append([68, "Released under the MIT License.\nThe rest of it is plain text.", "en", "s2"])
    rows.append([69, "a <|endoftext|> b and<|endoftext|>\nmore of it", "en", "s2"])
    return [(*r, len(r[1] or "")) for r in rows]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The corpus as a stored table, with extra columns whose names clash with what operators make."""
    from pyspark.sql import functions as F

    from braidwork.llm.common import drop_stored, stored

    df = spark.createDataFrame(rows, DDL).repartition(5)
    for name in ("size", "slot", "key", "block", "class", "n", "label", "row", "root", "piece", "__row", "__use", "__uses", "__block", "__shard", "__n_words", "__kept", "__lines", "__words"):
        df = df.withColumn(name, F.lit(f"other {name}"))
    yield stored(df, "corpus")
    drop_stored(spark)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DDL)
