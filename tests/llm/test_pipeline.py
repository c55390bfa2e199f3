"""The corpus pipeline against a brute-force version of all its stages, on a small corpus."""

import random
import re

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.llm.helpers import awkward, documents
from tests.llm.test_quality_and_lines import line_brute_force, measures, slow_quality
from tests.llm.test_scans import overlap_brute_force
from tests.llm.test_simhash import slow_print
from wardflow.llm import bpe_transducer, weak_quality
from wardflow.llm.queries import vocabulary


def pattern(text):
    """Votes of the rules, in their order."""
    n, chars, symbols, dups, repeats = measures(text)
    upper = sum(c.isupper() for c in text)
    marks = symbols + text.count("!")
    stops = text.count(".") + text.count("?")
    lines = len([x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)])
    bad = [symbols * 10 > n, symbols * 4 > n, marks * 5 > n, upper * 3 > chars, text.count("!") * 10 > n,
           chars < 2 * n or chars > 12 * n, stops * 100 < n, dups * 3 > lines, repeats * 5 > n]
    prose = marks * 50 <= n and 0 < upper * 10 <= chars and stops * 50 >= n and 3 * n <= chars <= 9 * n
    fresh = marks * 50 <= n and repeats * 10 <= n and dups * 5 <= lines
    votes = [weak_quality.BAD if b else weak_quality.ABSTAIN for b in bad]
    return (*votes, *[weak_quality.GOOD if g else weak_quality.ABSTAIN for g in (prose, fresh)])


def brute_force(rows, items):
    votes = [pattern(text) for _, text in rows]
    quality = dict(zip(votes, slow_quality(votes), strict=True))

    def good(text):
        n, repeats = measures(text)[0], measures(text)[4]
        return n >= 10 and 100 * repeats <= 20 * n and quality[pattern(text)] >= 0.5

    rows = [(i, t) for i, t in rows if good(t)]
    cut = {k[0]: v for k, v in line_brute_force(rows).items()}
    rows = [(i, cut[i]) for i, t in rows if cut[i].strip() or cut[i] == t]
    prints = {i: slow_print(t) for i, t in rows}
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    rows = [(i, t) for i, t in rows if find(i) == i]
    hit = {i for (i, _), v in overlap_brute_force(rows, items).items() if v[3]}
    ranks = bpe_transducer.read_ranks(vocabulary("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return {i: library.encode_ordinary(t) for i, t in rows if i not in hit}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("ba", "lo", "mi", "ter", "sun") for b in ("ra", "ne", "ty", "gol", "vex", "ip")]

    def sentence():
        return " ".join([rng.choice(words).capitalize(), *[rng.choice(words) for _ in range(rng.randint(5, 14))]]) + "."

    rows = [(i, "\n".join(" ".join(sentence() for _ in range(3)) for _ in range(rng.randint(1, 5)))) for i in range(60)]
    items = [(k, " ".join(rng.choice(words) for _ in range(25))) for k in range(5)]
    rows += [(100 + i, rows[i][1]) for i in range(5)]
    rows += [(110 + i, rows[10 + i][1].replace(".", ";", 1)) for i in range(5)]
    rows += [(120 + i, rows[20 + i][1].split("\n")[0] + "\n" + sentence() * 2) for i in range(5)]
    rows += [(130 + i, f"{sentence()} {items[i][1]} {sentence()}\n{sentence()}") for i in range(5)]
    rows += [(140 + i, " ".join(f"{rng.choice(words)}%%%" for _ in range(40))) for i in range(8)]
    rows += [(150 + i, " ".join(f"{rng.choice(words).upper()}!!" for _ in range(40))) for i in range(8)]
    rows += [(160, "Too short."), (161, ""), (162, f"{sentence()} " * 6)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_pipeline_is_brute_force(spark, corpus):
    folder, rows, items = corpus
    got = {r["doc_id"]: list(r["ids"]) for r in corpus_pipeline.run(spark, folder).collect()}
    assert got == brute_force(rows, items)
    assert 40 < len(got) < len(rows) - 25


def test_stages_keep_the_columns_and_take_awkward_rows(spark, corpus):
    docs = awkward(spark, extra=("n_lines", "row", "kept", "fingerprint"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, corpus[0])
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert out.count() <= docs.count()
        assert stage(spark, docs.limit(0), corpus[0]).count() == 0
    assert len(corpus_pipeline.STAGES[-1][1](spark, docs, corpus[0]).collect()) == docs.count()


def test_lines_update_the_length(spark, corpus):
    docs = documents(spark, [(1, "One line of words here.\nMore words."), (2, "One line of words here.\nOther end.")])
    out = {r["doc_id"]: r for r in corpus_pipeline.lines(spark, docs, corpus[0]).collect()}
    assert out[2]["text"] == "Other end." and out[2]["n_chars"] == 10
    assert out[1]["text"] == "One line of words here.\nMore words."


def test_last_stage_decodes_its_ids(spark):
    import hashlib

    texts = ["Plain words, 中文 and 😀.", "", None]
    rows = corpus_pipeline.token_ids(spark, documents(spark, list(enumerate(texts))), "").collect()
    got = {r["doc_id"]: (bool(r["ids"]), r["decoded_sha256"]) for r in rows}
    assert got == {k: (bool(t), hashlib.sha256((t or "").encode()).hexdigest()) for k, t in enumerate(texts)}
