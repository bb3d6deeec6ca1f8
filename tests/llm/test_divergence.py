"""Quality rules against plain Python."""

import math
import random
import re
from statistics import median

from millrace.llm import divergence

SCHEMA = "doc_id long, text string, lang string, n_words string, chars string, kept int, source string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else None
    if twice is None:
        counts = {}
        for w in windows:
            counts[w] = counts.get(w, 0) + 1
        twice = {w for w, n in counts.items() if n > 1}
    hit = {k for i, w in enumerate(windows) if w in twice for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def histograms(text, lang):
    text = text or ""
    n = [len(re.findall(p, text)) for p in ("[a-z]", "[A-Z]", "[0-9]")]
    beyond = sum(ord(c) > 127 for c in text)
    space = len(text) - sum(map(len, WORD.findall(text)))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    chars = [*n, space, symbols, len(text) - space - sum(n) - symbols - beyond, beyond]
    words = divergence.COMMON_WORDS.get(lang)
    if words is None:
        return chars, None
    plain = re.findall(r"[^\W\d_]+", text.lower())
    found = [plain.count(w) for w in words]
    return chars, [*found, max(len(WORD.findall(text)), sum(found)) - sum(found)]


def distance(p, q):
    p, q = ([x / max(1, sum(c)) for x in c] for c in (p, q))
    part = lambda x, m: x * math.log2(x / m) if x else 0.0
    return math.sqrt(max(0.0, sum((part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2 for a, b in zip(p, q))))


def usual(rows, hist, enough):
    """Typical counts by language: medians over documents, then over sources, in steps."""
    shares = {}
    for r, h, ok in zip(rows, hist, enough):
        if ok and h is not None:
            shares.setdefault(r[2], {}).setdefault(r[6], []).append([math.floor(x / max(1, sum(h)) * divergence.SHARE_BINS) for x in h])
    return {lang: [math.floor(median(median(col) for col in cols) * 4) for cols in zip(*[list(zip(*docs)) for docs in by.values()])]
            for lang, by in shares.items()}


def test_equals_plain_python(spark):
    rng = random.Random(9)
    rows = []
    for i in range(160):
        lang = rng.choice(["en", "de", "xx", None])
        common = divergence.COMMON_WORDS.get(lang, ["aa", "bb"])
        words = [rng.choice(common) if rng.random() < 0.5 else "".join(rng.choice("abcdefgé") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(0, 300))]
        if rng.random() < 0.15:
            words = [w + "%%%" for w in words]
        if rng.random() < 0.15:
            words = words[:40] * rng.randrange(1, 6)
        if rng.random() < 0.15:
            words = " | ".join(words).split()
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words), lang, "clash", "clash", 3, rng.choice(["a", "b", "c", None])))
    rows += [(300, None, "en", "", "", 1, "a"), (301, "", None, "", "", 1, None), (302, "a\n\na\n \na", "en", "", "", 1, "a"),
             (303, "q r s t u v w x " * 2000, "en", "", "", 1, "b"), (None, rows[1][1], "en", "", "", 1, "a"), (2, rows[2][1], rows[2][2], "", "", 1, rows[2][6]),
             (304, " ".join(f"w{i}" for i in range(40_000)), "de", "", "", 1, "c")]
    out = divergence.judged(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    hist = [histograms(r[1], r[2]) for r in rows]
    stats = [base(r[1]) for r in rows]
    total = {}
    for r, s in zip(rows, stats):
        total[r[2]] = total.get(r[2], 0) + s[0]
    usual_chars = usual(rows, [h[0] for h in hist], [sum(h[0]) >= 200 for h in hist])
    usual_words = usual(rows, [h[1] for h in hist], [s[0] >= 50 for s in stats])
    want = []
    for r, (chars, common), s in zip(rows, hist, stats):
        large = total[r[2]] >= 5000
        c = distance(chars, usual_chars[r[2]]) if large and sum(chars) >= 200 else None
        w = distance(common, usual_words[r[2]]) if large and s[0] >= 50 and common else None
        failed = s[0] < 20 or 100 * s[4] > 30 * s[0]
        k = len(common) - 1 if common else 0
        far = (c is not None and c * c > 0.03 + 6 / sum(chars)) or (w is not None and w * w > 0.01 + (k + 4 * math.sqrt(2 * k)) / (8 * math.log(2)) / s[0])
        want.append((r[0], *s, failed, not failed and not far, c and round(c, 7), w and round(w, 7)))
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept,
            r.char_distance and round(r.char_distance, 7), r.word_distance and round(r.word_distance, 7)) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(x[7] for x in got) and any(not x[6] and not x[7] for x in got)
    assert divergence.judged(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_third_of_junk_is_rejected(spark):
    """One source of symbol-decorated texts, longer than the others, holds a third of the rows and most of one language's."""
    rng = random.Random(4)
    word = lambda lang: rng.choice(divergence.COMMON_WORDS[lang]) if rng.random() < 0.3 else "".join(rng.choice("abcdefghilnorst") for _ in range(rng.randrange(2, 9)))
    rows = []
    for i in range(240):
        lang = ["en", "de"][i % 2]
        rows.append((i, " ".join(word(lang).capitalize() if rng.random() < 0.1 else word(lang) for _ in range(120)), lang, f"src{i % 6}"))
    for i in range(240, 360):
        rows.append((i, " ".join(word("en") + rng.choice(["###", "$$$", "%%%"]) for _ in range(400)), "en", "hot"))
    out = divergence.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)).collect()
    assert len(out) == 360 and not any(r.base_failed for r in out)
    assert sorted(r.doc_id for r in out if r.kept) == list(range(240))


def prose(rng, lang, n):
    """Words of an own vocabulary with the language's common words at falling rates, as texts have them."""
    common = divergence.COMMON_WORDS[lang]
    weights = [1 / (i + 2) for i in range(len(common))]
    word = lambda: rng.choices(common, weights)[0] if rng.random() < 0.35 else "".join(rng.choice("abcdefghilnorst") for _ in range(rng.randrange(3, 9)))
    return [word() for _ in range(n)]


def test_tables_and_word_salad_go_and_clean_texts_stay(spark):
    rng, rows = random.Random(6), []
    for i in range(400):
        lang = ["en", "fr"][i % 2]
        words = prose(rng, lang, rng.choice([60, 120, 300, 1500]))
        rows.append((i, "".join(w + rng.choice([" ", " ", " ", ", ", ". ", "\n"]) for w in words), lang, f"s{i % 5}", True))
    for i in range(400, 440):  # tables
        rows.append((i, "\n".join(" | ".join(prose(rng, "en", 5)) for _ in range(rng.choice([30, 100]))), "en", f"s{i % 5}", False))
    for i in range(440, 480):  # every word as often as any other
        salad = [rng.choice(divergence.COMMON_WORDS["fr"] + ["xyz", "uvw", "rst"]) for _ in range(rng.choice([150, 500]))]
        rows.append((i, " ".join(salad), "fr", f"s{i % 5}", False))
    for i in range(480, 520):  # in another language than it says
        rows.append((i, " ".join(prose(rng, "fr", 200)), "en", f"s{i % 5}", False))
    out = divergence.judged(spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")).collect()
    assert not any(r.base_failed for r in out)
    kept = {r.doc_id for r in out if r.kept}
    clean = {r[0] for r in rows if r[4]}
    assert len(clean - kept) <= 1 and len(kept - clean) <= 2


def test_plain_text_keeps_only_words_that_may_be_common(spark):
    from millrace.llm import divergence

    text = "Of the elephants, the nicht-important the; extraordinary THE of. unbelievable, wonderful of"
    rows = spark.createDataFrame([(1, text, "en", None)], "doc_id long, text string, lang string, source string")
    found = divergence._with_statistics(rows).select("_plain", "common").first()
    assert found["_plain"].split() == "of the the nicht the the of of".split()
    assert found["common"][:2] == [4, 3] and sum(found["common"]) == 12


def test_long_runs_only_where_shorter_ones_repeat(spark):
    from millrace.llm import divergence

    eight = "a b c d e f g h"
    texts = [" ".join(f"w{i}" for i in range(30)), f"{eight} x {eight} y", f"a b c d x {eight} y"]
    rows = spark.createDataFrame([(i, t, "en", None) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    found = divergence._with_statistics(rows).orderBy("doc_id").select(f"_run{divergence.REPEAT_WINDOW}", "n_repeat_words").collect()
    assert found[0][0] is None and [r[1] for r in found] == [0, 16, 0]
