"""The pipeline's language stage: what resembles no language goes, short clean texts stay, wrong labels are put right."""

import random
import string

import corpus_pipeline

EN = "the of and to in that was his with they this have from which one had word but not what all were when your can said there use each she how their will other about out many then them these some her would make like him into time has look two more write see number way could people than first water been call who oil now find long down day did get come made may part over such take because good only little work know place year live back give most very after thing our just name sentence man think great where help through much before line right too mean old any same tell boy follow came want show also around form three small set put end does another well large must big even land here".split()
DE = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei hatte kann gegen vom können schon wenn habe seine mark ihre dann unter wir soll ich eines jahr zwei jahren diese dieser wieder keine uhr seiner worden will zwischen immer millionen was sagte gibt alle seit muss wurden beim doch jetzt waren drei jahre neue neuen damit bereits da ihr seinen müssen ab ihrer ohne sondern selbst ersten nun etwa heute ihren weil ihm menschen deutschland anderen rund ihn ende jedoch zeit".split()
FINNISH = "Tänä aamuna menimme kauppaan ostamaan leipää ja maitoa koko perheelle, minkä jälkeen kävelimme järven rantaa pitkin kotiin ja keitimme kahvia."


def test_language_stage(spark, tmp_path):
    rng = random.Random(21)

    def text(words, n):
        return " ".join(rng.choice(words) for _ in range(n))

    def noise(letters, n):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(n))

    rows = [(i, text(EN if i % 2 else DE, 80), "en" if i % 2 else "de") for i in range(240)]
    stay = [(1000, "There was little water.", None, "en"), (1001, "Die Menschen sind heute ohne Zeit.", None, "de"), (1002, "they want more time", "en", "en"), (1003, text(DE, 60), "en", "de"), (1004, "that that that that that", "en", "en")]
    go = [(2000 + i, noise(string.ascii_lowercase, 60), "en" if i % 2 else None) for i in range(8)]
    go += [(2100 + i, noise("абвгдежзийклмнопрстуфхцчшщыэюя", 60), None) for i in range(4)] + [(2200 + i, noise([chr(0x4E00 + k) for k in range(2000)], 60), "de") for i in range(4)]
    go += [(2300 + i, noise(string.ascii_letters + string.digits + "+/", 40), "en") for i in range(4)] + [(2400, FINNISH, None), (2401, "Сегодня утром мы пошли в магазин, чтобы купить хлеб и молоко для семьи.", None)]
    docs = spark.createDataFrame([(i, t, x) for i, t, x, *_ in [*rows, *stay, *go]], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language_id(spark, docs, str(tmp_path)).collect()}
    assert got == {i: x for i, _, x in rows} | {i: x for i, _, _, x in stay}
