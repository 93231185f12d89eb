"""Language identification rejects languages it never learned, and keeps short and mixed texts."""

import random

import pytest

from millrace.llm import langid

WORDS = {
    "en": "the house and morning with people water which through their should under thing "
    "because night would again another those every great world while school never",
    "de": "das haus und morgen mit leuten wasser welche durch ihre sollte unter sache weil nacht "
    "würde wieder andere jene jeder große welt während schule niemals",
    "fi": "talo ja aamulla kanssa ihmisten vesi joka läpi heidän pitäisi alla asia koska yöllä "
    "taas toinen nuo jokainen suuri maailma koulussa koskaan kyllä",
}


def text(lang, n, rng):
    return " ".join(rng.choices(WORDS[lang].split(), k=n))


@pytest.mark.parametrize("left_out", [("fi",), ("en", "fi"), ("de",)])
def test_left_out_language_is_rejected(spark, left_out):
    rng = random.Random(1)
    learned = [lang for lang in WORDS if lang not in left_out]
    rows = [(i, text(learned[i % len(learned)], rng.randint(3, 80), rng), learned[i % len(learned)])
            for i in range(240)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = {}
    for lang in learned:
        asked |= {f"{lang}{n}": text(lang, n, rng) for n in (3, 8, 60)}
    asked["mixed"] = " ".join(text(lang, 20, rng) for lang in learned)
    strange = {f"{lang}{n}": text(lang, n, rng) for lang in left_out for n in (3, 8, 60)}
    strange["letters"] = "xkcdq zzrw pqkj vvbnm qwrtp lkjhg"
    strange["cyrillic"] = "все счастливые семьи похожи друг на друга"
    df = spark.createDataFrame([*(asked | strange).items()], "doc_id string, text string")
    found = {r["doc_id"]: r for r in langid.identify(df, model).collect()}
    assert {k for k, r in found.items() if r["rejected"]} == set(strange)
    assert all(found[f"{lang}{n}"]["lang_pred"] == lang for lang in learned for n in (3, 8, 60))
