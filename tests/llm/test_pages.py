"""Boilerplate, spam, cutoffs and mixing on small rows."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from loamstone.llm import boilerplate, cutoffs, mixing, page_labels, spam


# --- boilerplate ---
def test_sum_product_is_exact():
    """Marginals by messages are those of all labellings."""
    lines = [(i + 1, t, False) for i, t in enumerate(["Home", "A title of some words here", "One sentence that ends here now.", "Trending now", "Another title of some words", "A sentence under it.", "Top"])]
    kinds, names, _ = boilerplate.page_features("", "", lines)
    parent, edge = boilerplate.tree_of(kinds)
    rng = random.Random(1)
    model = boilerplate.Weights(0.1, {x: rng.uniform(-1, 1) for f in names for x in f}, {e: tuple(rng.uniform(0.2, 3) for _ in range(4)) for e in edge})
    own = [model.odds(f, []) for f in names]
    total, sums = 0.0, [0.0] * len(lines)
    for labels in itertools.product((0, 1), repeat=len(lines)):
        p = math.prod(o if y else 1.0 for o, y in zip(own, labels, strict=True))
        for i, q in enumerate(parent):
            if q >= 0:
                p *= model.edges[edge[i]][labels[q] * 2 + labels[i]]
        total += p
        sums = [s + p * y for s, y in zip(sums, labels, strict=True)]
    assert model.marginals(own, parent, edge) == pytest.approx([s / total for s in sums])


def _pages(spark, data):
    return [r.content for r in spark.read.parquet(f"{data}/raw.parquet").select("content").where("length(content) > 0").orderBy("raw_id").collect()]


def test_held_out_pages(spark, data):
    """On pages it was not trained on, the model agrees with the rules that label its training pages, also by shape alone."""
    pages = _pages(spark, data)
    model = boilerplate.PageModel.train(pages[::2])
    right = shape = total = 0
    for content in pages[1::2]:
        site, title, lines = boilerplate.parts_of(content)
        if lines:
            marks = page_labels.labelled(site, title, lines)
            right += sum((p > 0.5) == bool(y) for p, y in zip(model.marginals(site, title, lines), marks, strict=True))
            shape += sum((p > 0.5) == bool(y) for p, y in zip(model.marginals(site, title, lines, False), marks, strict=True))
            total += len(lines)
    assert total > 300 and right / total > 0.97 and shape / total > 0.9


#: A page in a language that no rule and no training page knows; 1 marks its furniture.
SWEDISH = [
    (1, "Hem"), (1, "Om oss"), (1, "Statistik"), (1, "Kontakt"), (0, "Riksbanken lämnar styrräntan oförändrad i höst"),
    (0, "Direktionen beslutade på torsdagen att lämna styrräntan oförändrad. Inflationen har fallit tillbaka mot målet, men hushållens konsumtion är fortsatt svag."),
    (0, "Exporten steg under det tredje kvartalet, medan bostadsbyggandet minskade. Ledamöterna väntar sig att tillväxten tar fart först nästa år."),
    (0, "Bedömningen är att kronan stärks gradvis. En ny prognos publiceras i december."),
    (1, "Läs också"), (1, "› Bankernas utlåning ökar i långsam takt"), (1, "› Så påverkas räntan av hösten"), (1, "› Ny rapport om betalningar"), (1, "© 2024 Riksbanken"), (1, "Till toppen"),
]


def test_unknown_language(spark, data):
    model = boilerplate.PageModel.train(_pages(spark, data))
    lines = [(i + 1, t, False) for i, (_, t) in enumerate(SWEDISH)]
    got = [p > 0.5 for p in model.marginals("", SWEDISH[4][1], lines)]
    assert sum(g == bool(y) for g, (y, _) in zip(got, SWEDISH, strict=True)) >= 0.9 * len(SWEDISH)
    # without messages between the lines the shapes of single lines decide
    kinds, names, _ = boilerplate.page_features("", SWEDISH[4][1], lines)
    assert [model.shape.odds(f, []) > 1 for f in names] != [] and len(kinds) == len(SWEDISH)


def test_page_cases(spark, data):
    raw = spark.read.parquet(f"{data}/raw.parquet").select("content").where("length(content) > 0")
    model = boilerplate.train_model(raw, "content")
    page = "TITLE: Growth in Norland slows\r\nURL: u\r\n\r\nHome | About us | Contact | News\r\n\r\nGrowth in Norland slows\r\n\r\nThe economy grew by two percent. Prices rose as well, and wages followed.\r\n\r\n© 2024 Site. All rights reserved."
    rows = [(1, page), (1, page), (2, None), (3, ""), (4, " \n \n"), (None, "Back to top"), (5, "x " * 300_000), (6, "TITLE: only a header")]
    df = spark.createDataFrame(rows, "raw_id long, content string").withColumn("line_no", F.lit(0))
    got = sorted((r.raw_id or 0, r.line_no) for r in boilerplate.boilerplate_lines(df, "raw_id", "content", model=model).collect())
    assert [g for g in got if g[0] == 1] == [(1, 4), (1, 4), (1, 10), (1, 10)] and (0, 1) in got
    assert not [g for g in got if g[0] in (2, 3, 4, 6)]
    text = {r.raw_id: r.text for r in boilerplate.boilerplate_free(df.where("raw_id IN (1, 2, 3)"), "raw_id", "content", model).collect()}
    assert text[1].startswith("Growth in Norland slows\nThe economy") and text[2] is None and text[3] == ""
    assert boilerplate.boilerplate_lines(df.limit(0), "raw_id", "content", model=model).count() == 0


# --- spam ---
PROSE = "The committee noted that the pace of growth had slowed over the year, and it expects prices to rise by less than two percent. " * 3
SPAM = {
    "tags": "#CheapLoan #BestBank " * 20, "soup": "cheap loan best bank fast credit " * 20, "links": "\n".join(f"[loan {i}](https://x{i}.example/a)" for i in range(12)),
    "urls": "\n".join(f"https://x{i}.example/loan" for i in range(12)), "shop": "\n".join(f"Gold round new {i}.99" for i in range(12)), "bars": " | ".join(f"best loan in Town{i}" for i in range(15)),
    "keyword": "Looking for cheap loan? Our cheap loan page lists cheap loan and more cheap loan. " * 6, "titles": "\n".join(f"How rates affect bank {i} - site{i}.example" for i in range(12)),
    "lines": "\n".join(f"cheap loan offer number {w}" for w in "abcdefghijkl"),
}
HAM = {
    "prose": PROSE, "tagged": PROSE + "\nTags: rates | growth | prices | wages", "table": "\n".join(f"Norland{i}\t{i}.5\t{i}.7\t3" for i in range(20)),
    "snapshot": "SERIES: X\nDIRECTION: up\n" + "\n".join(f"- 2024-01-{i:02d}: {i}.5" for i in range(1, 25)), "programme": "\n".join(f"{h:02d}:00 Session: growth and prices (Bank of Norland)" for h in range(8, 20)),
    "qa": "Q: How do rates affect growth?\nA: " + PROSE, "title": "Growth in Norland slows", "null": None, "empty": "", "blank": " \n\t", "signs": "!!! ??? ---",
}


def test_spam_kinds(spark):
    rows = [(k, t) for k, t in {**SPAM, **HAM}.items()] + [(f"p{i}", PROSE) for i in range(20)] + [("soup", SPAM["soup"]), (None, SPAM["soup"])]
    df = spark.createDataFrame(rows, "doc_id string, text string").withColumn("words", F.lit("clash"))
    got = [r.doc_id for r in spam.stuffed_pages(df, "doc_id", "text").collect()]
    assert {g for g in got if g} == set(SPAM) and got.count("soup") == 2 and got.count(None) == 1
    assert spam.stuffed_pages(df.limit(0), "doc_id", "text").count() == 0


def test_spam_long(spark):
    df = spark.createDataFrame([(1, PROSE * 2000), (2, "a-" * 400_000), (3, "cheap loan " * 100_000)], "doc_id int, text string")
    assert {r.doc_id for r in spam.stuffed_pages(df, "doc_id", "text").collect()} >= {3}


def test_spam_middle_lines(spark):
    """Lines of 11 to 24 keywords without separators are found like longer ones."""
    rng = random.Random(3)
    words = [a + b for a in ("cred", "mort", "bond", "fund", "swap", "debt", "cash", "gold") for b in ("ora", "ilo", "une", "ist", "ark", "emo", "oli", "ant")]
    rows = [(n, "\n".join(" ".join(rng.sample(words, n)) for _ in range(12))) for n in (11, 18, 24, 25)]
    rows += [(100 + i, PROSE) for i in range(20)] + [(200, "\n".join(["The growth of prices in the region has slowed over the last year and it may slow more"] * 3))]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    assert {r.doc_id for r in spam.stuffed_pages(df, "doc_id", "text").collect()} == {11, 18, 24, 25}


def test_spam_scripts(spark):
    """Lists, menus and repeated keywords in scripts without words are found; sentences are not."""
    prose = "物価上昇率は昨年の水準を再び低下した。短期金利は前月より横ばいで推移した。国債利回りは四半期ベースで下回った。銀行貸出は市場予想を小幅に上昇した。外貨準備は季節調整後で、わずかに改善した。"
    found = {
        "bars": "格安ローン｜即日融資｜住宅ローン｜銀行口座｜低金利｜無料相談｜外貨預金", "commas": "格安贷款，银行贷款，房屋贷款，信用贷款，汽车贷款，快速贷款", "blanks": "格安ローン 即日融資 住宅ローン 銀行口座 低金利 無料相談",
        "menu": "\n".join(f"{x}一覧" for x in "東西南北春夏秋冬上下"), "links": "\n".join(f"[格安ローン情報]({i})" for i in range(9)), "copies": "格安ローンはこちらへ。\n" * 6,
        "keyword": "格安ローンなら格安ローン店。格安ローン情報と格安ローン比較。格安ローン相談。" * 2, "korean": "저렴한 대출 | 은행 대출 | 주택 대출 | 신용 대출 | 빠른 대출 | 무료 상담", "thai": "สินเชื่อ " * 12,
    }
    plain = {
        "ja": prose, "long": prose * 2 + "\n" + prose, "zh": "委员会指出，去年经济增长放缓，物价上涨，工资也随之上升，出口下降。预计今年价格涨幅将低于百分之二。", "ko": "위원회는 지난해 성장세가 둔화되었다고 밝혔다. 물가는 올해 이 퍼센트 미만으로 오를 것으로 예상된다.",
        "th": "คณะกรรมการ ระบุว่า การเติบโต ชะลอตัวลง ในปีที่ผ่านมา และคาดว่า ราคา จะสูงขึ้น", "title": "外貨準備の改善",
    }
    df = spark.createDataFrame(list({**found, **plain}.items()), "doc_id string, text string")
    assert {r.doc_id for r in spam.stuffed_pages(df, "doc_id", "text").collect()} == set(found)


PLAIN = {
    "ru": ["Центральный банк сообщил, что темпы роста экономики замедлились в прошлом году.", "По мнению комитета, цены будут расти не так быстро, как осенью.", "Он не видит причин для снижения ставки, но готов к этому и в следующем году."],
    "ar": ["قال البنك المركزي في تقرير له إن النمو قد تباطأ في العام الماضي.", "ومن المتوقع أن ترتفع الأسعار في هذا العام ولكن ليس كما في السابق.", "لم يجد المجلس ما يدعو إلى خفض سعر الفائدة في الوقت الحالي من العام."],
    "pl": ["Bank centralny podał, że tempo wzrostu gospodarki w ubiegłym roku spadło do trzech procent.", "Rada nie widzi powodów, aby obniżyć stopy, ale jest na to gotowa i za rok.", "W ocenie członków rady ceny nie będą rosły tak szybko, jak na jesieni."],
    "ja": ["中央銀行は昨年の成長率が鈍化したことを明らかにした。", "委員会は物価が秋ほど速くは上がらないと見ている。", "金利を下げる理由は見当たらないが、来年にはその用意もある。"],
    "zh": ["央行表示，去年的经济增长有所放缓，但是物价的上涨仍然在目标之上。", "委员会认为，今年的物价不会像去年秋天一样上涨得那么快。", "目前没有降低利率的理由，不过明年也可以有所准备。"],
    "sv": ["Riksbanken meddelade att tillväxten i ekonomin har minskat under det senaste året.", "Enligt ledamöterna kommer priserna inte att stiga så fort som de gjorde i höstas.", "Det finns inga skäl att sänka räntan, men banken är beredd att göra det nästa år."],
}
KEYWORDS = {
    "ru": "кредит онлайн ипотека вклад страхование займ карта банк выгодно быстро дешево рефинансирование", "ar": "قرض سريع بطاقة ائتمان تمويل عقاري تأمين سيارات استثمار ذهب تداول أسهم رخيص",
    "pl": "kredyt gotówkowy pożyczka chwilówka lokata ubezpieczenie hipoteka karta leasing tanio szybko online", "ja": "格安ローン 即日融資 住宅ローン 銀行口座 低金利 無料相談 外貨預金", "zh": "低息贷款 房屋贷款 信用卡 快速放款 汽车贷款 免费咨询 外汇开户",
    "sv": "snabblån kreditkort bolån försäkring sparkonto billigt fonder aktier guld räntefritt privatlån utbetalning",
}


def test_spam_languages(spark):
    """No language is condemned for having no list of function words, and stuffed pages of each are found."""
    rng, plain, stuffed = random.Random(5), [], []
    for lang, sentences in PLAIN.items():
        between = "" if lang in ("ja", "zh") else " "
        keywords = KEYWORDS[lang].split()
        for i in range(24):
            text = between.join(rng.choice(sentences) for _ in range(12))
            if i % 3 == 1 and between:  # wrapped lines
                w = text.split()
                text = "\n".join(" ".join(w[k : k + 12]) for k in range(0, len(w), 12))
            plain.append((f"{lang}{i}", text))
        for i in range(10):
            words = [rng.choice(keywords) for _ in range(120)]
            kinds = [" ".join(words), " | ".join(words), "\n".join(" ".join(words[k : k + 14]) for k in range(0, 120, 14)), "\n".join(f"[{w} {k}](https://x{k}.example)" for k, w in enumerate(words[:20]))]
            stuffed.append((f"{lang}-s{i}", kinds[i % 4]))
    df = spark.createDataFrame(plain + stuffed, "doc_id string, text string")
    got = {r.doc_id for r in spam.stuffed_pages(df, "doc_id", "text").collect()}
    assert not got & {k for k, _ in plain} and len(got) >= 0.9 * len(stuffed)
    # single pages: nothing calibrates their language, so it is not held against them
    few = spark.createDataFrame([(k, ("" if k in ("ja", "zh") else " ").join(x)) for k, x in PLAIN.items()], "doc_id string, text string")
    assert not spam.stuffed_pages(few, "doc_id", "text").count()


# --- cutoffs ---
def test_cutoffs(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(0, 12)])) for _ in range(400)] + [("one", 5), ("ties", 7), ("ties", 7)]
    targets = [("a", 10.0), ("a", 25.0), ("b", 100.0), ("c", None), ("gone", 50.0), ("one", 1.0), ("ties", 50.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "domain string, score int").withColumn("cutoff", F.lit(1))
    share = spark.createDataFrame(targets, "domain string, keep_pct double")
    got = {r.domain: (r.cutoff, r.kept, r.counted) for r in cutoffs.score_cutoffs(df, "domain", "score", share, "keep_pct").collect()}
    for d, pct in {"a": 25, "b": 100, "c": 100, "one": 1, "ties": 50}.items():
        own = sorted((s for k, s in rows if k == d and s is not None), reverse=True)
        cut = max(s for s in own if sum(x >= s for x in own) * 100 >= pct * len(own))
        assert got.pop(d) == (cut, sum(x >= cut for x in own), len(own))
    assert not got and cutoffs.score_cutoffs(df.limit(0), "domain", "score", share, "keep_pct").count() == 0


def test_one_per_id(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 1), (None, "y", 2), (None, "y", 2)], "id string, d string, s int")
    assert sorted((r.d, r.s) for r in cutoffs.one_per_id(df, "id", F.col("d"), F.col("s")).collect()) == [("x", 1), ("y", 2), ("y", 2)]


# --- mixing ---
def test_tempering():
    assert mixing.tempered([0.5, 0.5, 0], [0.9, 0.1, 0], 0) == [0.5, 0.5, 0] and mixing.tempered([0.5, 0.5], [0.9, 0.1], 1) == pytest.approx([0.9, 0.1])
    x = mixing.exponent_for_entropy([0.9, 0.1], 0.5)
    assert mixing.entropy(mixing.tempered([1, 1], [0.9, 0.1], x)) == pytest.approx(0.5)


def test_mix(spark):
    rng = random.Random(3)
    docs = [(i, s, rng.randint(1, 400)) for i, s in enumerate(rng.choices(["big", "mid", "small", "unwanted", None], [60, 30, 3, 5, 2], k=6000))] + [(9000, "big", 0), (9001, "big", None), (None, "mid", 50)]
    targets = [("big", 40, 1), ("mid", 40, 2), ("small", 15, 4), ("absent", 5, 9), (None, 3, 3)]
    df = spark.createDataFrame(docs, "doc_id long, source string, tokens int").withColumn("copies", F.lit(9))
    want = spark.createDataFrame(targets, "source string, weight_pct int, max_repeats int")
    for block in (50, 100_000):
        copies, sources, x = mixing.mix(df, want, block=block)
        rows = copies.collect()
        assert x == 0 and all(r.copies <= {"big": 1, "mid": 2, "small": 4}[r.source] and r.tokens > 0 for r in rows)
        size = {s: sum(r.tokens * r.copies for r in rows if r.source == s) for s in ("big", "mid", "small")}
        for s, w in (("big", 40), ("mid", 40), ("small", 15)):
            assert size[s] / sum(size.values()) == pytest.approx(w / 95, abs=0.002)
        report = {r.source: r for r in mixing.shares(copies, sources).collect()}
        assert report["absent"].mixed_tokens == 0 and report["small"].mixed_tokens == size["small"] and report["small"].most_copies == 4
    # a larger budget tempers the weights until no source repeats too often
    copies, sources, x = mixing.mix(df, want, budget=1_000_000.0)
    rows = copies.collect()
    assert 0 < x < 1 and all(r.copies <= {"big": 1, "mid": 2, "small": 4}[r.source] for r in rows)
    assert mixing.mix(df.limit(0), want)[0].count() == 0 and mixing.mix(df, want.limit(0))[0].count() == 0


def test_many_sources(spark, monkeypatch):
    """Beyond the limit of the driver's plan the table's plan gives the same mix."""
    rng = random.Random(4)
    docs = [(i, f"s{rng.randint(0, 5) ** 2 // 5}", rng.randint(1, 300)) for i in range(3000)]
    targets = [("s0", 30, 1), ("s1", 30, 3), ("s3", 20, 2), ("s5", 20, 4), ("absent", 7, 2)]
    df = spark.createDataFrame(docs, "doc_id long, source string, tokens int")
    want = spark.createDataFrame(targets, "source string, weight_pct int, max_repeats int")
    for budget in (None, 600_000.0, 1e9):
        monkeypatch.setattr(mixing, "MOST_SOURCES", 100)
        copies, sources, x = mixing.mix(df, want, budget=budget)
        few = {r.source: r for r in mixing.shares(copies, sources, x).collect()}
        monkeypatch.setattr(mixing, "MOST_SOURCES", 2)
        copies, table, y = mixing.mix(df, want, budget=budget)
        many = {r.source: r for r in mixing.shares(copies, table, y).collect()}
        assert y == pytest.approx(x, abs=1e-6) and set(few) == set(many)
        for s in few:
            assert many[s].mixed_tokens == pytest.approx(few[s].mixed_tokens, abs=300) and many[s].most_copies <= many[s].max_repeats


def test_entropy_target(spark):
    docs = spark.createDataFrame([(i, "big" if i % 10 else "small", 100) for i in range(1000)], "doc_id long, source string, tokens int")
    want = spark.createDataFrame([("big", 1, 1), ("small", 99, 5)], "source string, weight_pct int, max_repeats int")
    tempered, x = mixing.entropy_targets(docs, want, evenness=0.8)
    weights = {r.source: r.weight_pct / 100 for r in tempered.collect()}
    assert 0 < x < 1 and mixing.entropy(list(weights.values())) == pytest.approx(0.8 * math.log(2))
    copies, sources, _ = mixing.mix(docs, tempered)
    got = {r.source: r for r in mixing.shares(copies, sources, x).collect()}
    assert got["small"].actual_pct / 100 == pytest.approx(weights["small"], abs=0.005) and got["small"].exponent == x
