from collections import Counter

from braidwork.llm import repetition

from .conftest import WORD, words


def base(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def test_counts_and_verdict(docs, rows):
    got = repetition.repetition_report(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r.doc_id, *[r[n] for n in names]) for r in got) == Counter((r[0], *base(r[1])) for r in rows)
    assert all(not r.kept for r in got if r.base_failed)
    assert {r.doc_id: r.kept for r in got}[20] and not {r.doc_id: r.kept for r in got}[67]


def test_keep_good_keeps_columns(docs, empty):
    kept = repetition.keep_good(docs)
    assert kept.columns == docs.columns and kept.where("size = 'other size'").count() == kept.count() > 40
    assert repetition.keep_good(empty).count() == 0 and repetition.repetition_report(empty).count() == 0


def test_repeated_passage_is_rejected(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text), (2, text + " " + text), (3, text + " " + " ".join(f"w{i}" for i in range(12)))]
    got = {r.doc_id: r for r in repetition.repetition_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].kept and not got[2].kept and got[2].base_failed
    # 12 of 92 words stand again: no 5-gram share over 0.15, but the 9-gram share is over 0.11
    assert got[3].n_repeat_words == 24 and not got[3].base_failed and not got[3].kept


def test_shares_are_measured_for_every_text(spark):
    # five of 105 words stand again: far below every limit, yet a share
    text = " ".join([*(f"w{i:03}" for i in range(100)), "w000 w001 w002 w003 w004"])
    (got,) = repetition.repetition_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert got.kept and abs(got.dup_gram_shares[0] - 5 / 105) < 1e-9 and got.dup_gram_shares[1:] == [0.0] * (len(got.dup_gram_shares) - 1)
