"""Line cleaning (op6) and license scan (op8) against plain forms."""

import re
from collections import Counter

from lakeloom.llm import licenses, lines
from lakeloom.tables import load
from tests.conftest import SF001
from tests.llm import cases


def plain_lines(text):
    text = text or ""
    w = cases.words(text)
    n = len(w)
    grams = Counter(tuple(w[k:k + 8]) for k in range(n - 7))
    cover = {k + j for k in range(n - 7) if grams[tuple(w[k:k + 8])] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if cases.WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover),
            n < 20 or 100 * len(cover) > 30 * n)


def _base(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_line_figures(spark):
    for df in (cases.frame(spark), load(spark, SF001, "documents")):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        report = lines.judge(df).collect()
        assert sorted((str(i), *plain_lines(t)) for i, t in rows) == sorted((str(r.doc_id), *_base(r)) for r in report)
        assert not any(r.kept for r in report if r.base_failed)
    assert lines.judge(cases.frame(spark, [])).count() == 0


def test_line_rules():
    prose = "The committee met again on Monday, and the minutes were read aloud to all members present."
    assert lines.line_fault(prose) is None
    assert lines.line_fault("Home | News | Sport | Contact | About") == "navigation"
    assert lines.line_fault("word " * 25) == "punctuation"
    assert lines.line_fault("buy$$$ it### now!!! from%%% us&&&") == "punctuation"
    assert lines.line_fault("ALL OF THIS LINE IS SHOUTED.") == "shouting"
    assert lines.line_fault("go. " * 12) == "monotony"
    assert lines.line_fault("aa. aa. aa. bb bb bb cc cc cc dd dd") == "monotony"
    assert lines.line_fault("This site uses cookies to improve your visit.") == "boilerplate"
    assert lines.line_fault("Der Rat trat am Montag zusammen. Été à Paris, où l'on parle.") is None
    kept, faults = lines.clean_lines("\n".join([prose, "", prose, "A | B | C | D"]))
    assert kept == [prose, ""] and faults == {"repetition": 1, "navigation": 1}


def test_paragraphs_of_other_scripts_stay(spark):
    """Danda, Arabic question mark, Armenian and Ethiopic stops, full-width marks; Thai has none."""
    words = {"hi": ("यह एक लंबा अनुच्छेद है जिसमें", "।"), "ar": ("هذه فقرة طويلة من النص العربي", "؟"),
             "hy": ("սա երկար պարբերություն է որ", "։"), "am": ("ይህ ረጅም አንቀጽ ነው", "።"), "my": ("ဤသည် ရှည်လျားသော စာပိုဒ် ဖြစ်သည်", "။"),
             "th": ("นี่คือ ย่อหน้า ยาว ของ ข้อความ ภาษา", ""), "el": ("αυτή είναι μια μεγάλη παράγραφος", ";")}
    rows = []
    for n, (own, mark) in enumerate(words.values()):
        own = own.split()
        rows.append((n, "\n".join(" ".join(own[(i * k + i) % len(own)] + str(i * k) for i in range(25)) + mark for k in range(1, 5))))
    report = lines.judge(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert all(r.kept and r.share_lost == 0 for r in report), report
    assert lines.line_fault("word, " * 3 + " ".join(f"w{i}" for i in range(25))) == "punctuation"


def test_documents_losing_too_much_go(spark):
    prose = [f"Sentence number {i} tells of place {i * 7} and of day {i * 3}." for i in range(8)]
    menu = [f"Home{i} | News{i} | Sport{i} | Contact{i}" for i in range(40)]
    rows = [(1, "\n".join(prose)), (2, "\n".join(prose + menu[:3])), (3, "\n".join(prose[:2] + menu))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    report = {r.doc_id: r for r in lines.judge(df, with_text=True).collect()}
    assert [report[i].kept for i in (1, 2, 3)] == [True, True, False]
    assert report[1].share_lost == 0 and report[2].text == rows[0][1]


def test_labelled_quality_is_told_apart(spark):
    kept = lines.judge(load(spark, SF001, "documents")).join(load(spark, SF001, "labels"), "doc_id")
    good = kept.where("quality = 1 AND NOT base_failed").collect()
    bad = kept.where("quality = 0").collect()
    assert all(r.kept for r in good) and sum(r.kept for r in bad) <= 0.05 * len(bad)


def plain_licenses(text, threshold=licenses.THRESHOLD):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = [(k, label) for p, label in licenses.PHRASES for k in range(len(w))
              if w[k:k + len(p.split())] == p.split()]
    base = {label for _, label in places}
    labels, best = set(base), 1.0 if base else 0.0
    for label, t in licenses.TEMPLATES:
        width, t = 2 * len(t.split()), set(t.split())
        if len(t & set(w)) >= threshold * len(t) - 1e-12:
            share = max(len(t & set(w[s:s + width])) / len(t) for s in range(len(w)))
            if share >= threshold - 1e-12:
                labels.add(label)
                best = max(best, share)
    at = [k for k, _ in places]
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), best)


def test_licenses(spark):
    filler = cases.passage("q", 70)
    own = [(100, "MIT license, Apache-License! CC BY; cc-by 4.0", "l"),
           (101, filler + " Permission is hereby granted, free of charge, to any person obtaining a copy of software.", "l"),
           (102, filler[:150] + " Licensed under the GNU Affero General Public License " + filler, "l"),
           (103, "licensed under the mit", "l"), (104, "mit\nlicense mit license", "l"),
           (105, "Redistribution and use in source and binary forms, with modification, are permitted", "l")]
    rows = cases.documents() + [(i, t, None, s, 0, 0, "", 0) for i, t, s in own]
    got = sorted(((str(r[0]), *r[1:]) for r in licenses.scan(cases.frame(spark, rows)).collect()), key=str)
    assert got == sorted(((str(r[0]), *plain_licenses(r[1])) for r in rows), key=str)
    by_id = {r[0]: r for r in got}
    assert by_id["100"][2] == 4 and by_id["100"][6] == "apache,cc-by,mit"
    assert by_id["101"][6] == "mit" and by_id["101"][5] == "" and 0.9 <= by_id["101"][7] < 1
    assert by_id["102"][6] == "agpl,gpl" or by_id["102"][6] == "agpl"
    assert licenses.scan(cases.frame(spark, [])).count() == 0


def test_the_label_does_not_depend_on_where_the_notice_stands():
    """A notice with words between its words, behind 0 to 64 others; and whole paragraphs."""
    index = licenses.Index(licenses.TEMPLATES, {}, licenses.THRESHOLD)
    notice = "permission is hereby granted free of charge to any person obtaining a copy of this software".split()
    spread = " ".join(f"{w} x{i}" if i % 8 else w for i, w in enumerate(notice))
    found = {licenses.scan_text(("q " * k + spread + " z" * 40).encode(), index, [])[5:] for k in range(65)}
    assert len(found) == 1 and found.pop()[0] == "mit"
    for label, t in licenses.TEMPLATES:
        words = t.split()
        short = " ".join(w for i, w in enumerate(words) if len(words) < 20 or i % 30 != 7)
        for k in (0, 31, 200):
            labels = licenses.scan_text(("q " * k + short).encode(), index, [])[5].split(",")
            assert label in labels
    tripled = " ".join(f"{w} a{i} b{i}" for i, w in enumerate(notice))
    assert licenses.scan_text(tripled.encode(), index, [])[5] == ""  # more than half of the block is other words


def test_license_filters_lose_nothing():
    """Prefix, length and position against every template, block and threshold."""
    import random

    rng = random.Random(3)
    words = sorted({w for _, t in licenses.TEMPLATES[:15] for w in t.split()})
    for threshold in (0.3, 0.6, 0.8, 1.0):
        counts = {w.encode(): rng.randrange(5) for w in words}
        index = licenses.Index(licenses.TEMPLATES[:15], counts, threshold)
        for _ in range(150):
            text = rng.choices(words + ["zzz"] * 9, k=rng.randrange(1, 120))
            ranks = licenses.np.array([index.rank.get(w.encode(), 0) for w in text])
            every = {}
            for i, (_, t) in enumerate(licenses.TEMPLATES[:15]):
                width, own = 2 * len(t.split()), set(t.split())
                share = max(len(own & set(text[s:s + width])) for s in range(len(text))) / len(own)
                if share >= threshold - 1e-9:
                    every[i] = share
            assert index.match(ranks) == every
