import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline

from .conftest import DDL, WORD, words
from .test_mixing import shares
from .test_repetition import base
from .test_sigtree import groups
from .test_spans import cleaned


def good(text):
    """The quality rules, written out."""
    text = text or ""
    w = words(text)
    n, chars, symbols, _, _, failed = base(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += sum(map(len, words(line))) if line in seen else 0
            seen.add(line)
    fine = not failed and repeated <= 0.30 * chars and symbols <= 0.10 * n
    for k, most in {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}.items():
        earlier, covered = set(), set()
        for i in range(len(w) - k + 1):
            g = tuple(w[i : i + k])
            if g in earlier:
                covered |= set(range(i, i + k))
            earlier.add(g)
        fine = fine and sum(len(w[j]) for j in covered) <= most * chars
    return fine


def one_of_each(rows):
    members = defaultdict(list)
    for i, _, root in groups([(i, r[1]) for i, r in enumerate(rows)]):
        members[root].append(i)
    return [rows[min(own, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))] for own in members.values()]


def without_spans(rows):
    kept = {(d, total, gone): text for (d, total, gone, text) in cleaned(rows)}
    out = []
    for r in rows:
        (total, gone, text), *more = [(total, gone, text) for (d, total, gone), text in kept.items() if d == r[0] and total == len(words(r[1]))]
        assert not more
        if not gone or gone < total:
            out.append((r[0], text if gone else r[1], *r[2:]))
    return out


def mixed(rows):
    sizes, by_source = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
        by_source[r[3]].append(r)
    target = shares(sizes, (5, 2, 1), 1.5, 2.0)
    out = []
    for source, own in by_source.items():
        left = int(target[source] + 1e-9)
        own.sort(key=lambda r: (hashlib.md5(f"mix:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0]))
        while left > 0:
            for r in own:
                w = words(r[1])
                if left > 0 and w:
                    out.append(r if left >= len(w) else (r[0], " ".join(w[:left]), *r[2:]))
                    left -= min(left, len(w))
    return out


def pieces(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = Counter()
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2]
        at, piece = 0, 0
        while at < len(ids):
            n = len(ids) % 1024 or 1024 if at == 0 else 1024
            out[(r[0], piece, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes()))] += 1
            at, piece = at + n, piece + 1
    return out


def test_stages_against_brute_force(spark, tmp_path, rows):
    spark.createDataFrame(rows, DDL).write.parquet(str(tmp_path / "documents.parquet"))
    docs, want = spark.read.parquet(str(tmp_path / "documents.parquet")), rows
    steps = {"quality": lambda x: [r for r in x if good(r[1])], "near_duplicates": one_of_each, "repeated_spans": without_spans, "source_mix": mixed}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            break
        before, want = len(want), steps[name](want)
        assert docs.columns == DDL.replace(" long", "").replace(" string", "").split(", ")
        assert Counter(map(tuple, docs.collect())) == Counter(map(tuple, want)), name
        assert 0 < len(want) < before or name in ("repeated_spans", "source_mix")
    packed = docs.collect()
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(tuple(r[c] for c in key) for r in packed) == pieces(want)
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        ends = [0, *(a + n for a, n in sorted(parts))]
        assert [a for a, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 1024
    again = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(tuple(r[c] for c in key) for r in again.collect()) == pieces(want)


def test_empty_tables(spark, tmp_path, empty):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rows_stay_when_splits_change(spark, tmp_path, rows):
    """Another number of file splits from one job to the next, as when executors come and go, changes no row."""
    many = [(1000 * i + j, f"{r[1]} copy {i}", *r[2:]) for i in range(4) for j, r in enumerate(rows) if r[1]]
    spark.createDataFrame(many, DDL).repartition(7).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    name, found = "spark.sql.files.maxPartitionBytes", {}
    before = spark.conf.get(name)
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.source_mix):
        spark.conf.set(name, before)
        found[stage] = Counter(r.doc_id for r in stage(spark, docs, "").collect())
        frame = stage(spark, docs, "")
        spark.conf.set(name, "16k")
        assert Counter(r.doc_id for r in frame.collect()) == found[stage]
    spark.conf.set(name, before)
