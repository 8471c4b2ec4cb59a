import random

from millrace.llm import quality
from tests.conftest import rows

COMMON = {"spaced": frozenset("the a of and to in is was that it for on with as his they be at one have this from der die und das ist el la de que y".split()), "unspaced": frozenset(["的", "了", "は", "が"])}


def kind(text):
    return quality.describe(text, COMMON)[-1]


def test_prose():
    assert kind("The band played one song, and it was the last of the night.") == "prose"
    assert kind("it was late and the band played on with the lights off as they have for years") == "prose"
    wrapped = "The tape was on the table and\nit was the one that they have\nkept in the box for years, as\nthe label was to be paid at the\nend of it."
    assert kind(wrapped) == "prose"
    assert kind(wrapped + "\n\n- one thing\n- other thing\n") == "prose"
    assert kind("录音师在深夜录下了最后的尾奏。\n\n乐队在木头房间里保留了开头的和弦。") == "prose"


def test_lists():
    assert kind("Tracks\n1. Alder\n2. Birch (take 2)\n3. Cedar - 3:20") == "list"
    assert kind("- one\n\n- two\n\n- three") == "list"
    assert kind("drums;\nflute,\nlate fade\ncello,\nharp;") == "list"
    assert kind("Step 1: The choir sang the part.\nStep 2: It was put on tape.\nStep 3: They went home.") == "list"
    assert kind("- the part of the band\n    that was on tape\n    for a year\n- the other part\n    that they have\n    kept as it is") == "list"
    assert kind("Mix: Ona Tel\nKeys: Ravi Mo\nCover: Lin Sa") == "list"
    assert kind("一、开头的和弦\n二、最后的尾奏\n・第二段") == "list"


def test_tables():
    assert kind("| a | b |\n| --- | --- |\n| 1 | x |\n| 2 | y |") == "table"
    assert kind("key,bpm,note\nA,120.5,\"dry, warm\"\nB,99.0,bright\nC,101.2,dark") == "table"
    assert kind("a\t1\tx\nb\t2\ty\nc\t3\tz") == "table"
    assert kind("key     bpm     side\nA       120             \nB       99      A\nC               B\n") == "table"
    assert kind("k=1  v=2\nk=3  v=4\nk=5  v=6") == "table"


def test_junk():
    rnd = random.Random(1)
    assert kind("loading...\n" * 40) == "junk"
    assert kind("click to play " * 50) == "junk"
    assert kind("".join(rnd.choice("ABCDEFGHabcdefgh0123456789+/") for _ in range(600))) == "junk"
    assert kind(" ".join(f"{rnd.randrange(256):02x}" for _ in range(200))) == "junk"
    assert kind("<div class='a'></div>&nbsp;<i></i>{}" * 7 + "<b>x</b>") == "junk"
    assert kind("�" * 50 + "的录" + "�" * 9) == "junk"
    assert kind("的录音师在深夜。".encode().decode("latin-1") * 3) == "junk"
    assert kind("".join(rnd.choice("~|<>=+-_*/#. ") for _ in range(300))) == "junk"
    assert kind(" ".join("".join(rnd.choice("qwrtpsdfjklz" * 2 + "aeiou") for _ in range(rnd.randint(3, 14))) for _ in range(80))) == "junk"


def test_nothing_and_long():
    for t in (None, "", " \n\t "):
        assert kind(t) is None
    long = "The band was on the stage and it was late. They have played for one hour, as it is. " * 3
    assert kind("\n".join(long + str(i) for i in range(3000))) == "prose"
    assert kind("x" * 300_000) == "junk"


def test_sentence_marks_before_long_padding():
    for tail in (" " * 60, "”" * 50, "🎵" * 45, "  ’)" * 20, ""):
        assert quality.describe("The band was on." + tail + "\nIt was late" + tail + "\nWas it late?!" + tail, COMMON)[5] == 2 / 3
    for long in ("." * 200_000 + "x", "🎵 " * 100_000 + "x", "one, two" + "." * 300_000 + " x\n" + "a, b"):
        assert quality.describe(long, COMMON)[5] == 0


def test_more_common_words_than_a_hundred_thousand(spark):
    df = spark.range(100_002).selectExpr("concat('w', id) AS word")
    assert len(quality.common_words(df)["spaced"]) == 100_002


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "z"), (None, "The band was on the stage.", "z"), (3, "- a\n- b\n- c", "z"), (3, "- a\n- b\n- c", "z")], "doc_id bigint, text string, kind string")
    got = quality.text_statistics(df, COMMON)
    assert [r["kind"] for r in got.orderBy("doc_id").collect()] == ["prose", None, "list", "list"]
    assert rows(quality.text_statistics(df.limit(0), COMMON)) == []
    one = got.where("doc_id IS NULL").first()
    assert one["word_count"] == 6 and one["n_lines"] == 1 and one["end_punct_ratio"] == 1.0 and abs(one["common_word_ratio"] - 4 / 6) < 1e-9
