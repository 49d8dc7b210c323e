import re
from collections import Counter

import odd
import pytest
from pyspark.sql import functions as F

from stockweek.llm.quality_rules import RESULTS, clean_lines, line_passes, lines_with_words

COUNTS = RESULTS[:6]


def expected(text):
    text = text or ""
    w = odd.words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {
        p for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)
    }
    lines = [x for x in text.split("\n") if odd.words(x)]
    failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    symbols = sum(map(text.count, "#*$%&|<>"))
    return (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(inside), failed)


def test_counts_of_odd_documents(spark):
    found = clean_lines(odd.documents(spark), keep=("doc_id", "text", "n_words")).collect()
    assert len(found) == len(odd.texts())
    for row in found:
        assert tuple(row[c] for c in COUNTS) == expected(row["text"]), row["text"][:50]
        assert not (row["kept"] and row["base_failed"])


@pytest.mark.parametrize(
    "text",
    ["a b c d e " * 2, "a b c d e x a b c d e", "x " * 30, "a b a b a b a b", "a b c d e f g h i j k"]
    + [" ".join("abcab"[i * i % 5] for i in range(n)) for n in (9, 40, 200)],
)
def test_repeated_words(spark, text):
    row = clean_lines(odd.documents(spark, [(1, text)])).first()
    assert tuple(row[c] for c in COUNTS) == expected(text)


def test_no_python_on_the_way(spark):
    plan = clean_lines(odd.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange hash|Exchange range", plan)


@pytest.mark.parametrize(
    "line,kept",
    [
        ("The weather was fine all day, and we went out.", True),
        ("Short heading", True),
        ("", True),
        ("Home | News | Sport | Contact | About | Help", False),
        ("a#### b$$$$ c%%%% d&&&& e**** f####", False),
        ("BUY!! THIS!! NOW!! IT!! IS!! CHEAP!!", False),
        ("one two three four five six seven eight nine ten eleven twelve thirteen", False),
        ("We use cookies to make this site better.", False),
        ("Subscribe to our newsletter!", False),
        ("The baker said that cookies are best eaten warm, with a glass of milk beside them.", True),
    ],
)
def test_line_rules(spark, line, kept):
    row = spark.createDataFrame([(line,)], "x string").select(lines_with_words(F.col("x")).alias("l"))
    assert row.select(line_passes(F.element_at("l", 1))).first()[0] is kept


def test_a_document_that_loses_most_of_its_lines_goes(spark):
    good = "The weather was fine all day, and so we went out to the lake."
    menus = [" | ".join(f"Item{i}{j}" for j in range(7)) for i in range(9)]
    rows = [(1, f"{good}\n{menus[0]}"), (2, "\n".join([good, *menus]))]
    found = {r["doc_id"]: r for r in clean_lines(odd.documents(spark, rows)).collect()}
    assert found[1]["kept"] and found[1]["clean_text"] == good
    assert not found[2]["kept"] and not found[2]["base_failed"]


def test_empty_table(spark):
    assert clean_lines(odd.documents(spark, [])).collect() == []


# Two sentences of each, as they are written, with more than eight words in most scripts.
PROSE = {
    "Hindi": "आज सुबह मौसम बहुत अच्छा था और हम सब लोग बाहर घूमने गए। दोपहर में हमने घर लौटकर साथ खाना खाया।",
    "Urdu": "آج صبح موسم بہت اچھا تھا اور ہم سب لوگ باہر گھومنے گئے۔ کیا آپ بھی ہمارے ساتھ وہاں چلنا چاہتے تھے؟",
    "Arabic": "ذهب الولد إلى المدرسة في الصباح مع أخته الصغيرة وعاد في المساء. هل تعرف أين يسكن هذا الولد الآن؟",
    "Chinese": "今天 的 天气 非常 好 我们 都 出去 散步 了。 下午 我们 一起 回家 吃饭 然后 看 书。",
    "Japanese": "今日は とても いい 天気 なので みんな で 公園 へ 行きました。 とても 楽しかった です！",
    "Russian": "Сегодня утром была хорошая погода, и мы все вместе пошли гулять. Вечером мы вернулись домой.",
    "Greek": "Σήμερα το πρωί ο καιρός ήταν πολύ καλός και βγήκαμε όλοι έξω. Πού πήγατε εσείς χθες το βράδυ;",
    "Armenian": "Այսօր եղանակը շատ լավ էր և մենք բոլորս միասին դուրս եկանք քաղաք։ Երեկոյան մենք տուն վերադարձանք։",
    "Amharic": "ዛሬ ጠዋት አየሩ በጣም ጥሩ ነበር እና ሁላችንም አብረን ወደ ውጭ ወጣን። ማታ ወደ ቤት ተመለስን።",
    "Thai": "วันนี้ อากาศ ดี มาก เรา ทุกคน ออกไป เดินเล่น ที่ สวน ด้วยกัน แล้ว กลับ บ้าน ตอน เย็น",
    "Burmese": "ယနေ့ မနက် ရာသီဥတု အလွန် ကောင်း ပြီး ကျွန်တော်တို့ အားလုံး အပြင် ထွက် ခဲ့ ကြ သည်။",
    "Tibetan": "དེ་རིང གནམ་གཤིས ཡག་པོ འདུག ང་ཚོ ཚང་མ ཕྱི་ལོགས ལ འགྲོ རྒྱུ ཡིན།",
}


@pytest.mark.parametrize("language", PROSE)
def test_prose_of_other_scripts_is_kept(spark, language):
    row = clean_lines(odd.documents(spark, [(1, PROSE[language])])).first()
    assert row["kept"] and row["kept_share"] == 1.0


def test_phrases_by_language(spark):
    text = "Wir verwenden Kekse auf dieser Seite.\n" + PROSE["Russian"]
    docs = odd.documents(spark, [(1, text)])
    assert clean_lines(docs).first()["kept_share"] == 1.0
    found = clean_lines(docs, phrases={"de": "wir verwenden kekse", "fr": "en savoir plus"}).first()
    assert found["clean_text"] == PROSE["Russian"]
