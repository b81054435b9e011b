import re
from collections import Counter

import pytest

from punctual.llm import quality

SCHEMA = "doc_id long, text string, kept string, n_words int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, copies = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    inside = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    n = len(words)
    failed = n < 20 or 100 * len(inside) > 30 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), copies, len(inside), failed


PROSE = "It was a fine day in the old town, and all of them went out to see what it was about."
TEXTS = [
    None,
    "",
    "\n \n",
    "x y\n x y\nx y\nx y",
    "a b c d e f g h a b c d e f g h",
    "é中 " * 40,
    (PROSE + "\n") * 3,
    "one two three four five six seven eight nine ten " * 3,
    " ".join(f"w{i}" for i in range(50_000)) + ".",
    "#*$%&|<> text",
]


def test_counts_equal_brute_force(spark):
    rows = [(i, t, "z", 5) for i, t in enumerate(TEXTS)] + [(None, PROSE, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in quality.judged(df, columns=["doc_id"]).collect()}
    for doc_id, text, *_ in rows:
        r = got[doc_id]
        assert tuple(r)[1:7] == brute(text)
        assert not (r.kept and r.base_failed)


def test_counts_on_documents(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    got = {r.doc_id: r for r in quality.judged(df).collect()}
    for r in df.collect():
        assert tuple(got[r.doc_id][c] for c in (*quality.COUNTS, "base_failed")) == brute(r.text)


@pytest.mark.parametrize(
    "line, stays",
    [
        (PROSE, True),
        ("Home | News | Sport | Contact | About us.", False),
        ("one line of words that never comes to any end mark at all", False),
        ("BUY NOW!! CHEAP GOODS!! ONLY TODAY!!", False),
        ("Read more about our Privacy Policy.", False),
        ("the$$$ of%%% and### to&&& in***.", False),
        ("Title words", True),
        ("no no no no no no no no no.", False),
    ],
)
def test_line_rules(line, stays):
    found = quality.measure([f"{PROSE}\n{line}".encode()])
    assert found.line_stays.tolist() == [True, stays and line != PROSE]


WRAPPED = """\
It was a fine day in the old town, and all of them went
out to see what it was about. Nobody had told them that
the river was so high, but they saw it for themselves and
were not at all afraid of what the evening would bring to
their houses.

When the lamps were lit people sat down to eat, and there
was much talk of the weather, of the harvest and of a man
who had come over the hills."""


def test_wrapped_prose_stays():
    found = quality.measure([WRAPPED.encode(), WRAPPED.replace("\n", "\r\n").encode()])
    assert found.kept.all() and found.line_stays.all()


def test_a_paragraph_ends_at_blank_marked_and_navigation_lines():
    loose = "one line of words that never comes to any end mark at all"
    menu = "Home | News | Sport | Contact | About us"
    for text in (f"{loose}\n\n{PROSE}", f"{PROSE}\n{loose}", f"{loose}\n{menu}\n{PROSE}"):
        stays = quality.measure([text.encode()]).line_stays.tolist()
        assert stays == [line == PROSE for line in text.split("\n") if line]
    assert quality.measure([loose.encode(), PROSE.encode()]).line_stays.tolist() == [False, True]


@pytest.mark.parametrize("mark", ["।", "۔", "؟", "։", "።", "។", "\uff61", "\U00011047"])
def test_end_marks_of_other_scripts(mark):
    line = "यह एक पुराना शहर था और सब लोग वहाँ गए" + mark
    assert quality.measure([line.encode()]).line_stays.tolist() == [True]


def test_documents_that_lose_too_much_go(spark):
    menu = "Home | News | Sport | Contact | About us now"
    other = [
        PROSE,
        "Nobody had told them that the river was so high, but they saw it for themselves.",
        "When evening came the lamps were lit, and people sat down to eat in their houses.",
    ]
    rows = [
        (1, "\n".join(other), "a", 1),
        (2, "\n".join([other[0], *[menu + str(i) for i in range(6)]]), "b", 2),
        (3, "\n".join([*other, menu]), "c", 3),
        (4, None, "d", 4),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = quality.accepted(df)
    assert out.schema == df.schema
    assert sorted(map(tuple, out.collect())) == [rows[0], rows[2]]
    clean = {r.doc_id: r.cleaned_text for r in quality.cleaned(df).collect()}
    assert clean[3] == "\n".join(other) and clean[2] == other[0] and clean[4] == ""


def test_labels_agree(spark):
    """Documents labelled good stay unless they are too short; bad ones go."""
    sf = "/root/testdata/sf0.01"
    judged = quality.judged(spark.read.parquet(f"{sf}/documents.parquet"), columns=["doc_id"])
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = judged.join(labels, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.02 * len(bad)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert quality.judged(df).count() == 0 and quality.accepted(df).count() == 0


@pytest.mark.parametrize(
    "line",
    [
        "The whole catalog in the library was digitised during the winter.",
        "They asked for a design update for the bridge over the river.",
        "The farmers spread more straw on the field before the frost came.",
        "On her blog in the evening she wrote about the people of the town.",
    ],
)
def test_phrases_are_whole_words(line):
    found = quality.measure([("\n".join([line, "Another line of prose stands here."])).encode()])
    assert found.line_stays.all()


@pytest.mark.parametrize("line", ["Sign up now.", "Please log in.", "(Click here!)", "READ MORE."])
def test_phrases_by_themselves_are_boilerplate(line):
    found = quality.measure([f"A line of prose that stays as it is.\n{line}".encode()])
    assert found.line_stays.tolist() == [True, False]


def plain_kept(text):
    """Both rules word by word and line by line."""
    rules = quality.Rules()
    lines = (text or "").split("\n")
    words = [WORD.findall(line) for line in lines]
    n = sum(map(len, words))
    flat = [w for line in words for w in line]
    windows = Counter(tuple(flat[i : i + 8]) for i in range(n - 7))
    covered = set()
    for i in range(n - 7):
        if windows[tuple(flat[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    if n < rules.min_words or 100 * len(covered) > rules.max_repeat_percent * n:
        return False

    def menu(i):
        bars = sum(c in quality.SEPARATORS for c in lines[i])
        return bars >= rules.min_separators and bars >= rules.separator_share * len(words[i])

    def ends(i):
        return words[i][-1][-1] in quality.END_MARKS

    def failing(i, paragraph, earlier):
        line, mine = lines[i], words[i]
        many = len(mine) > rules.short_line
        marked = sum(w[-1] in quality.END_MARKS for j in paragraph for w in words[j])
        long = sum(len(words[j]) for j in paragraph)
        loud = 0
        for w in mine:
            upper = sum("A" <= c <= "Z" for c in w) >= 2 and not any("a" <= c <= "z" for c in w)
            loud += upper or w[-2:] in ("!!", "??")
        hung = sum(any(c in quality.SYMBOLS for c in w) for w in mine)
        echoes = sum(a == b for a, b in zip(mine, mine[1:]))
        edge = r"(?<![\w'\-])" + "(?:" + "|".join(quality.PHRASES) + ")" + r"(?![\w'\-])"
        stock = re.search(edge, re.sub("[A-Z]", lambda m: m[0].lower(), line))
        return (
            (not ends(paragraph[-1]) and marked * rules.words_per_mark < long and many)
            or (loud > rules.shout_share * len(mine) and many)
            or menu(i)
            or (hung > rules.symbol_share * len(mine) and many)
            or echoes > rules.stutter_share * len(mine)
            or (stock and len(mine) <= rules.phrase_words)
            or line in earlier
        )

    paragraphs, last = [], None
    for i in range(len(lines)):
        if not words[i]:
            continue
        if last is None or last != i - 1 or ends(last) or menu(last) or menu(i):
            paragraphs.append([])
        paragraphs[-1].append(i)
        last = i
    lost, earlier = 0, set()
    for paragraph in paragraphs:
        for i in paragraph:
            lost += sum(map(len, words[i])) if failing(i, paragraph, earlier) else 0
            earlier.add(lines[i])
    return lost <= rules.max_lost * sum(map(len, flat))


def test_verdicts_against_brute_force(spark, small):
    rng = __import__("random").Random(8)
    rows = [(r.doc_id, r.text, "k", 0) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    pieces = ["word one two three", "Prose of some words ends here.", "A | B | C | D", "BUY NOW OR NEVER!!", "###  $x %y",
              "the the the the", "Sign up today.", "", "   ", "Ünder größe\u2026", "half a sentence that", "goes on to its end?"]
    rows += [(10_000 + i, "\n".join(rng.choices(pieces, k=rng.randrange(1, 30))), "k", 0) for i in range(400)]
    got = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(rows, SCHEMA), columns=["doc_id"]).collect()}
    wrong = [r[0] for r in rows if got[r[0]] != plain_kept(r[1])]
    assert wrong == []
    assert 100 < sum(got.values()) < len(got)
