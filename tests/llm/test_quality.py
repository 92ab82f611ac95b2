import re
from collections import Counter
from math import comb

import pytest
from frames import TEXTS, documents, empty

from tidemark.llm import quality
from tidemark.llm.queries import op2_quality_rules
from tidemark.llm.shared import read_table

LABELS = "doc_id bigint, quality int, toxic int"


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("text", [t for _, t in TEXTS] + ["a b c d e a b c d e f", "1 2 3 4 5 6 " * 3, "#a *b\n#a *b\r\n#a *b"])
def test_counts(text):
    assert quality.counts(text or "")[:5] == slow_counts(text)


def test_binomial_is_exact():
    for n, p in [(10, 0.3), (200, 0.02), (1500, 0.004)]:
        for k in range(0, int(n * p)):
            exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            assert quality.binomial_below(k, n, p) == pytest.approx(exact, rel=1e-9)
    assert quality.binomial_below(5, 10, 0.3) == 1
    assert not quality.safe(0, 0, 0.1, 0.05)


def test_cutoffs_reject_junk_and_keep_good_rows(spark):
    good = [(i, f"Good text number {i} with plain words that differ {i * 7} from the others here.") for i in range(3000)]
    junk = [(10_000 + i, " ".join(f"w{i + j}$$$&&&" for j in range(20))) for i in range(50)]
    docs = spark.createDataFrame([(*d, "en") for d in good + junk], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in junk], LABELS)
    kept = {r.doc_id for r in quality.drop_low_quality(docs, labels).collect()}
    assert kept == {i for i, _ in good}


def test_without_labels_only_the_base_rules_reject(spark):
    found = quality.judged(documents(spark), spark.createDataFrame([], LABELS)).collect()
    assert len(found) == len(TEXTS)
    for r in found:
        n_words, *_, repeats = slow_counts(r.row.text)
        assert r.base_failed == (n_words < 10 or 100 * repeats > 20 * n_words)
        assert r.kept != r.base_failed


def test_null_and_repeated_labels(spark):
    labels = spark.createDataFrame([(None, 1, 0), (1, None, None), (1, 1, 0), (1, 0, 0), (5, 1, 1)], LABELS)
    assert quality.judged(documents(spark), labels).count() == len(TEXTS)
    assert quality.judged(empty(spark), labels).count() == 0
    kept = quality.drop_low_quality(documents(spark), labels)
    assert kept.columns == documents(spark).columns


def test_a_few_hundred_labels_of_a_rare_language_suffice(spark):
    good = [(i, f"Good text number {i} with plain words that differ {i * 7} from the others here.") for i in range(300)]
    short = [(5_000 + i, f"too $$$ short {i}") for i in range(300)]  # fails the base rules; the cutoffs do not count it
    junk = [(10_000 + i, " ".join(f"w{i + j}$$$&&&" for j in range(20))) for i in range(50)]
    rows = [(*d, lang) for lang in ("de", "es") for d in good + short + junk]
    rows = [(i + 100_000 * (lang == "es"), t, lang) for i, t, lang in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 100_000 < 10_000), 0) for i, _, _ in rows], LABELS)
    kept = {r.doc_id for r in quality.drop_low_quality(docs, labels).collect()}
    assert kept == {i for i, _, _ in rows if i % 100_000 < 5_000}


def test_levels():
    clean = [0] * quality.LEVELS
    none = dict.fromkeys(quality.RULES, clean)
    of = lambda joint, single, n: set(quality.levels(joint, single, n, 0.02, 0.0125).values())
    assert of(clean, none, 216) == {0} and of(clean, none, 217) == {8}
    assert of([0, 0, 0, 1] + [300] * 4, none, 300) == {3}
    # A rule that good documents break from the mildest cutoff on holds no other back, given the labels.
    broken = [300] * quality.LEVELS
    found = quality.levels(broken, none | {"marks": broken}, 3000, 0.02, 0.0125)
    assert found == dict.fromkeys(quality.RULES, 8) | {"marks": 0}


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.1"  # the smaller tables have too few labels for any cutoff
    rows = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text").collect()
    good = {r.doc_id for r in read_table(spark, sf_dir, "labels").where("quality = 1").collect()}
    above = {}
    for r in rows:
        n_words, chars, symbols, lines, repeats = slow_counts(r.text)
        n_lines = len([x for x in (r.text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)])
        upper, marks = sum(c.isupper() for c in r.text or ""), len(re.findall(r"[.!?]", r.text or ""))
        pairs = {"symbols": (symbols, chars), "upper": (upper, chars), "marks": (marks, n_words)}
        pairs |= {"lines": (lines, n_lines), "repeats": (repeats, n_words)}
        base = n_words < 10 or 100 * repeats > 20 * n_words
        # The first level that rejects the document.
        hits = [j for j in range(8) for k, (a, b) in pairs.items() if b and a / b > quality.CUTOFFS[k][j]]
        above[r.doc_id] = (r.lang or "", base, min(hits, default=8))
    held = [above[i] for i in good if i in above and not above[i][1]]
    sizes = Counter(s for s, _, _ in held)
    level = dict.fromkeys((s for s, _, _ in above.values()), 0)
    for s, n in sizes.items():
        error = 0.05 / len(sizes)
        # Single rules are tested as well, which are never more levels than all rules at the last one.
        single = 0.996**n <= error / 10
        error = error / 2 if single else error
        for j in range(8):
            k = sum(x[0] == s and x[2] <= j for x in held)
            if k >= n * 0.02 or sum(comb(n, i) * 0.02**i * 0.98 ** (n - i) for i in range(k + 1)) > error:
                break
            level[s] = j + 1
        assert level[s] == 8 or not single
    assert min(level.values()) > 0
    found = {r.doc_id: (r.base_failed, r.kept) for r in op2_quality_rules(spark, sf_dir).collect()}
    assert found == {i: (base, not base and first >= level[s]) for i, (s, base, first) in above.items()}
