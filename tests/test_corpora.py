"""Each corpus plan from raw files to wide rows, expected rows written by hand."""

import json

import pytest

from labelweave.plans import CORPORA, catalog, get_corpus
from labelweave.plans.direct import GO_LABELS, GO_SCHEMA, PLUTCHIK, SEMEVAL_LABELS
from labelweave.plans.longwide import HURRICANES8_LABELS
from labelweave.plans.votes import (
    AROUSAL_QUESTION,
    ELECTORAL_LABELS,
    EMOTION_QUESTION,
    HURRICANES24_LABELS,
    VALENCE_QUESTIONS,
)


@pytest.fixture
def made(spark, tmp_path):
    """Write files, then read and build a corpus; rows come back as a sorted list."""

    def run(name, files, columns=None, **options):
        for path, text in files.items():
            target = tmp_path / path
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_text(text, encoding="utf8")
        corpus = get_corpus(name)
        df = corpus.build(corpus.read(spark, str(tmp_path)), **options)
        assert set(corpus.info.labels) <= set(df.columns)
        if columns:
            df = df.select(*[f"`{c}`" for c in columns])
        return sorted((tuple(r) for r in df.collect()), key=repr), df

    return run


def hot(labels, *on):
    return tuple(n in on for n in labels)


def test_registry(spark):
    assert len(CORPORA) == 25
    assert get_corpus("xed").name == "XED"
    with pytest.raises(KeyError, match="choose one of"):
        get_corpus("nope")
    rows = catalog(spark).collect()
    assert len(rows) == 25 and all(r.emotions and r.description for r in rows)


def test_affectivetext(made):
    rows, df = made(
        "AffectiveText",
        {
            "AffectiveText.trial/affectivetext_trial.xml": '<corpus>\n<instance id="1">Old</instance>\n'
            '<instance id="2">Two "q"</instance>\n<instance bad\n</corpus>\n',
            "AffectiveText.trial/affectivetext_trial.emotions.gold": "1 10 20 30 40 50 60\n3 1 2 3 4 5 6\n",
            "AffectiveText.trial/affectivetext_trial.valence.gold": "1 -50\n",
            "AffectiveText.test/affectivetext_test.xml": '<instance id="1">New</instance>\n',
            "AffectiveText.test/affectivetext_test.emotions.gold": "1 0 0 0 0 0 100\n",
            "AffectiveText.test/affectivetext_test.valence.gold": "4 25\n",
        },
    )
    assert df.columns == ["id", "text", "anger", "disgust", "fear", "joy", "sadness", "surprise", "valence"]
    assert rows == [
        (1, "New", 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, -0.5),
        (2, 'Two "q"', *[None] * 7),
        (3, None, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06, None),
        (4, None, *[None] * 6, 0.25),
    ]


def test_affectivetext_strict(spark, tmp_path):
    base = tmp_path / "AffectiveText.trial"
    base.mkdir()
    (base / "affectivetext_trial.xml").write_text("<instance bad\n")
    from labelweave.plans.records import AFFECTIVE_PREFIX, AFFECTIVE_RECORD
    from labelweave.sources import read_lines, regex_records

    lines = read_lines(spark, str(base / "affectivetext_trial.xml"))
    with pytest.raises(Exception, match="does not match"):
        regex_records(lines, AFFECTIVE_RECORD, ("id", "text"), AFFECTIVE_PREFIX, strict=True).collect()


def test_canceremo(made):
    files = {f"{n.capitalize()}_anon.csv": f"Sentence,{n.capitalize()}\n" for n in PLUTCHIK}
    files["Anger_anon.csv"] += '"a, b",1\nnull cell,\n"a, b",1\n'
    files["Trust_anon.csv"] += '"a, b",0\nother,1\n'
    rows, _ = made("CancerEmo", files, ["text", "anger", "fear", "trust"])
    assert rows == [("a, b", True, None, False), ("other", None, None, True)]


def test_carer(spark, tmp_path):
    corpus = get_corpus("CARER")
    for i, split in enumerate(("train", "validation", "test")):
        spark.createDataFrame([(split, i)], "text string, label int").write.parquet(
            f"{tmp_path}/{split}.parquet"
        )
    rows = corpus.build(corpus.read(spark, str(tmp_path))).orderBy("text").collect()
    assert rows[0].asDict() == {
        "text": "test", "sadness": False, "joy": False, "love": True, "anger": False,
        "fear": False, "surprise": False,
    }
    bad = spark.createDataFrame([("x", 6)], "text string, label int")
    with pytest.raises(Exception, match="unknown label code"):
        corpus.build({"train": bad, "validation": bad, "test": bad}).collect()


def test_crowdflower(made):
    rows, df = made(
        "CrowdFlower",
        {
            "data.csv": 'tweet_id,sentiment,author,content\n1,love,a,"hi ""x"", y"\n'
            '1,love,b,"hi ""x"", y"\n1,worry,c,"hi ""x"", y"\n2,odd,d,two\n'
        },
        ["tweet_id", "text", "love", "worry", "anger"],
    )
    assert rows == [("1", 'hi "x", y', 2, 1, 0), ("2", "two", 0, 0, 0)]
    assert dict(df.dtypes)["love"] == "bigint"


def electoral_files():
    def batch(name, lines):
        head = ["id", "extra", "trust", "tweet", EMOTION_QUESTION]
        head += [VALENCE_QUESTIONS[name], AROUSAL_QUESTION]
        return "\n".join("\t".join(x) for x in [head, *lines]) + "\n"

    high = "the emotion is being expressed with a high intensity"
    return {
        "Batch1/AnnotatedTweets.txt": batch(
            "Batch1",
            [
                ["2", "-", "0.5", "same", "like", "positive emotion", high],
                ["1", "-", "0.25", "same", "BLANK", "BLANK", "BLANK"],
                ["9", "short"],
                ["x", "-", "0.5", "same", "like", "positive emotion", high],
            ],
        ),
        "Batch2/AnnotatedTweets.txt": batch(
            "Batch2",
            [
                ["3", "-", "1.0", "same", "like", "who knows", high],
                ["4", "-", "1.0", "other", "hate", "negative emotion", high],
            ],
        ),
    }


def test_electoraltweets(made):
    columns = ["text", "ids", "annotator_trusts", "valence", "arousal", "like", "hate"]
    rows, df = made("ElectoralTweets", electoral_files(), columns)
    assert rows == [
        ("other", [4], [1.0], ["negative"], ["high"], 0, 1),
        ("same", [1, 2, 3], [0.25, 0.5, 1.0], [None, "positive", None], [None, "high", "high"], 2, 0),
    ]
    assert len(ELECTORAL_LABELS) == 19


def test_electoraltweets_in_parts(made):
    columns = ["text", "part", "ids", "like"]
    rows, _ = made("ElectoralTweets", electoral_files(), columns, items_per_part=2)
    assert rows == [("other", 0, [4], 0), ("same", 0, [1, 2], 2), ("same", 1, [3], None)]


def test_emobank(made):
    rows, _ = made(
        "EmoBank",
        {
            "emobank.csv": 'id,split,V,A,D,text\na,train,3.5,2.0,1.0,"x, y"\nb,dev,1.0,1.0,1.0,no meta\n',
            "meta.tsv": "id\tdocument\tcategory\tsubcategory\na\td1\tnews\t\nz\td2\tx\ty\n",
        },
    )
    assert rows == [("a", "d1", "news", None, "train", 3.5, 2.0, 1.0, "x, y")]


def test_emoint(made):
    rows, _ = made(
        "EmoInt",
        {
            "anger-train.csv": '1\tsame "x\tanger\t0.5\n2\tsame "x\tanger\t1.0\n',
            "joy-test.csv": '3\tsame "x\tjoy\t0.25\n4\tother\tjoy\t0.5\n',
        },
    )
    assert rows == [
        ([1, 2, 3], 'same "x', 0, 0.75, None, 0.25, None),
        ([4], "other", 0, None, None, 0.5, None),
    ]


def test_emotionstimulus(made):
    rows, _ = made(
        "EmotionStimulus",
        {
            "Emotion Cause.txt": "<happy>I  am glad <cause>that you &amp; he came<\\cause> . <\\happy>\n"
            "no tags here\n<happy>I smiled<\\happy> because <cause>it rained<\\cause> .\n",
            "No Cause.txt": "<sad>It is sad , really !<\\sad>\n<sad>It is sad, really!<\\sad>\n",
        },
        ["text", "happy", "sad", "anger"],
    )
    assert rows == [
        ("I am glad that you & he came.", True, False, False),
        ("I smiled", True, False, False),
        ("It is sad, really!", False, True, False),
    ]


def test_fbvalencearousal(made):
    rows, df = made(
        "FBValenceArousal",
        {"data.csv": 'Anonymized Message,Valence1,Valence2,Arousal1,Arousal2\n"m, n",3,4,1,\n'},
    )
    assert rows == [("m, n", 3.5, None)]
    assert df.dtypes[1:] == [("valence", "float"), ("arousal", "float")]


def test_goemotions(made):
    head = ",".join(f.name for f in GO_SCHEMA)
    cells = ",".join("1" if n in ("joy", "neutral") else "0" for n in GO_LABELS)
    rows, df = made(
        "GoEmotions",
        {
            "goemotions_1.csv": f"{head}\nhello,i1,au,sub,l,p,1548381039.0,37,False,{cells}\n",
            "goemotions_2.csv": f'{head}\n"two\nlines",i2,au,sub,l,p,1.0,1,True,{cells}\n',
        },
        ["id", "text", "rater_id", "example_very_unclear", "joy", "anger", "neutral"],
    )
    assert rows == [
        ("i1", "hello", 37, False, True, False, True),
        ("i2", "two\nlines", 1, True, True, False, True),
    ]


def test_goodnewseveryone(made):
    rows, _ = made(
        "GoodNewsEveryone",
        {
            "gne.tsv": "source\tid\theadline\tother\tdominant_emotion\tintensity\n"
            "bbc\t7\tHead, line\tz\tguilt\thigh\nbbc\t8\tNext\tz\tunheard\tlow\n"
        },
        ["id", "source", "text", "intensity", "guilt", "joy"],
    )
    assert rows == [
        ("7", "bbc", "Head, line", "high", True, False),
        ("8", "bbc", "Next", "low", False, False),
    ]


def test_hurricanes8(made):
    files = {}
    for label in HURRICANES8_LABELS:
        for split in ("train", "valid", "test"):
            files[f"{label}_{split}.csv"] = f"text,{label}\n"
    files["awe_train.csv"] += "storm,1\ncalm,0\n"
    files["awe_test.csv"] += "storm,1\n"
    files["love_valid.csv"] += "storm,0\n"
    rows, _ = made("Hurricanes8", files, ["text", "awe", "love", "remorse"])
    assert rows == [("calm", False, False, False), ("storm", True, False, False)]


def test_hurricanes24(made):
    def line(text, ballots):
        return json.dumps({"text": text, "annotations": ballots}) + "\n"

    full = {n: False for n in HURRICANES24_LABELS}
    rows, df = made(
        "Hurricanes24",
        {
            "harvey.jsonl": line("a b", {"w1": {**full, "joy": True}, "w2": {"joy": True, "fear": True}}),
            "irma.jsonl": line("ü", {"w1": {"fear": False}}),
        },
        ["hurricane", "text", "joy", "fear", "rage"],
    )
    assert rows == [("harvey", "a b", 2, 1, 0), ("irma", "ü", None, 0, None)]
    assert dict(df.dtypes)["joy"] == "bigint"


def test_isear(made):
    rows, _ = made(
        "ISEAR",
        {
            "isear.csv": "ID|MYKEY|EMOT|SIT\ns1|20|1|won a prize\ns1|10|7|told a lie\n"
            "s2|30|9|no code\ns3|40|short\n"
        },
    )
    assert rows == [
        (10, "s1", "told a lie", False, False, False, True, False, False, False),
        (20, "s1", "won a prize", False, False, False, False, True, False, False),
        (30, "s2", "no code", *[False] * 7),
    ]


def test_ren20k(made):
    rows, _ = made(
        "REN20k",
        {
            "REN-20k/REN-10k/a.csv": "Title, Content ,Happy,SAD,angry,don't care,inspired,afraid,amused,annoyed,\n"
            '"Caf+AOk-","multi\nline ",50,0,1,2,3,4,5,6,x\n'
            ",empty title,50,0,1,2,3,4,5,6,\n"
            "bad,number,n/a,0,1,2,3,4,5,6,\n"
            "too,short\n",
            "REN-20k/REN-10k+/b.csv": "annoyed,amused,afraid,inspired,don't care,angry,sad,happy,content,author\n"
            "100,0,0,0,0,0,0,0,second file,me\n",
        },
        ["title", "author", "text", "happy", "annoyed"],
    )
    assert rows == [
        ("", None, "empty title", 0.5, 0.06),
        ("Café", None, "multi\nline", 0.5, 0.06),
        (None, "me", "second file", 0.0, 1.0),
    ]


def test_semeval2018classification(made):
    head = "ID\tTweet\t" + "\t".join(SEMEVAL_LABELS)
    rows, _ = made(
        "Semeval2018Classification",
        {"E-c/a.txt": f'{head}\nt1\t"open quote\t1' + "\t0" * 10 + "\n"},
    )
    assert rows == [("t1", '"open quote', *hot(SEMEVAL_LABELS, "anger"))]


def semeval_files():
    head = "ID\tTweet\tAffect Dimension\tIntensity Score\n"
    return {
        "EI-reg/training/anger.txt": head + "1\tone\tanger\t0.5\n1\tone\tanger\t0.25\n",
        "EI-reg/dev/joy.txt": head + "2\ttwo\tjoy\t1.0\n",
        "V-reg/v.txt": head + "1\tone\tvalence\t0.75\n3\tthree\tvalence\t0.1\n",
    }


def test_semeval2018intensity(made):
    rows, _ = made("Semeval2018Intensity", semeval_files())
    assert rows == [
        ("1", "one", 0.75, 0.375, None, None, None),
        ("2", "two", None, None, None, 1.0, None),
        ("3", "three", 0.1, None, None, None, None),
    ]


def test_semeval2018intensity_left_keys(made):
    rows, _ = made("Semeval2018Intensity", semeval_files(), coalesce_keys=False)
    assert (None, None, 0.1, None, None, None, None) in rows and len(rows) == 3


def test_sentimentalliar(made):
    names = "statement,ID,subject,speaker,sentiment,sentiment_score,anger,fear,joy,disgust,sad"
    rows, _ = made(
        "SentimentalLIAR",
        {
            "train.csv": f'{names},context\n"s, 1",a,sub,who,NEG,0.5,0.1,0.2,0.3,0.4,0.5,radio\n',
            "test.csv": f"{names},unused\ns2,b,sub,who,POS,1,1,1,1,1,1,zzz\n",
        },
        ["ID", "statement", "context", "sentiment_score", "sad"],
    )
    assert rows == [("a", "s, 1", "radio", 0.5, 0.5), ("b", "s2", None, 1.0, 1.0)]


def test_ssec(made):
    rows, _ = made(
        "SSEC",
        {
            "train.csv": "Anger\t---\t---\t---\t---\t---\t---\tTrust\tfirst text\nshort\trow\n",
            "test.csv": "---\t" * 8 + "second\n",
        },
    )
    assert rows == [
        ("first text", *hot(PLUTCHIK, "anger", "trust")),
        ("second", *hot(PLUTCHIK)),
    ]


def test_stockemotions(made):
    head = "id,date,ticker,emo_label,senti_label,original,processed\n"
    rows, _ = made(
        "StockEmotions",
        {
            "train.csv": head + "1,2020,A,panic,bearish,sell,s\n1,2020,A,anger,bearish,sell,s\n",
            "val.csv": head + "2,2020,B,belief,bullish,buy,b1\n2,2021,B,belief,bullish,buy,b1\n",
        },
        ["id", "ticker", "text", "panic", "anger", "belief", "sentiment"],
    )
    assert rows == [
        ("1", "A", "sell", True, True, False, "bearish"),
        ("2", "B", "buy", False, False, True, "bullish"),
        ("2", "B", "buy", False, False, True, "bullish"),
    ]


TALES = {
    "Grimms/agree/emmood/frog.emmood": "0:a\tH:Su+\tN:N\t`Once a\t\"king`\n1:a\tSa:Sa\tN:N\tThe end\n",
}


def test_talesemotions(made):
    columns = ["author", "story", "sent_id", "text", "happy", "positively surprised", "sad", "neutral"]
    rows, _ = made("TalesEmotions", TALES, columns)
    assert rows == [
        ("Grimms", "frog", "0", 'Once a\t"king', 1, 1, 0, 0),
        ("Grimms", "frog", "1", "The end", 0, 0, 2, 0),
    ]


def test_talesemotions_first_rater_twice(made):
    rows, _ = made("TalesEmotions", TALES, ["sent_id", "happy", "sad"], first_rater_twice=True)
    assert rows == [("0", 2, 0), ("1", 0, 2)]


def test_talesemotions_unknown_code(made):
    with pytest.raises(Exception, match="unknown label code"):
        made("TalesEmotions", {"G/x/emmood/a.emmood": "0:a\tQ:H\tN:N\tt\n"})


def test_tec(made):
    rows, _ = made(
        "TEC",
        {
            "tweets.txt": "12:\tfish &amp; chips &eacute;\tmore\t:: joy\n12:\tfish &amp; chips &eacute;\tmore\t:: fear\n"
            "13:\tplain\t:: unknown\n"
        },
        ["id", "text", "joy", "fear", "anger"],
    )
    assert rows == [
        (12, "fish & chips é\tmore", True, True, False),
        (13, "plain", False, False, False),
    ]


def test_usvsthem(made):
    names = "anger,contempt,disgust,fear,gratitude,guilt,happiness,hope,pride,relief,sadness,sympathy"
    head = f"index,body,group,bias,usVSthem_scale,{names},emotions_neutral\n"
    rows, df = made(
        "UsVsThem",
        {"train.csv": head + '0,"b, c",Refugees,left,0.5,' + "0," * 11 + "1,0\n"},
        ["bias", "group", "usVSthem_scale", "text", "sympathy", "neutral"],
    )
    assert rows == [("left", "Refugees", 0.5, "b, c", 1, 0)]
    assert len(df.columns) == 6


def test_wassa22(made):
    rows, _ = made(
        "WASSA22",
        {
            "train.csv": "message_id,article_id,essay,emotion,empathy,distress,age\n"
            'm1,a1,"an\nessay",joy,1.5,2.5,30\n',
            "dev_features.csv": "message_id,article_id,essay\nm2,a2,second\nm3,a3,third\n",
            "dev_labels.csv": "4.0,5.0,anger\n6.0,7.0,neutral\n1.0,1.0,fear\n",
        },
        ["id", "article_id", "text", "empathy", "distress", "joy", "anger", "neutral", "fear"],
    )
    assert rows == [
        ("m1", "a1", "an\nessay", 1.5, 2.5, True, False, False, False),
        ("m2", "a2", "second", 4.0, 5.0, False, True, False, False),
        ("m3", "a3", "third", 6.0, 7.0, False, False, True, False),
        (None, None, None, 1.0, 1.0, False, False, False, True),
    ]


def test_xed(made):
    columns = ["text", "anger", "fear", "neutral"]
    files = {
        "emotion.tsv": "two labels\t1, 4\none\t9\n",
        "neutral.tsv": "0\tplain\nno tab here\n0\ttoo\tmany\n",
    }
    rows, _ = made("XED", files, columns)
    assert rows == [
        ("one", False, False, True), ("plain", False, False, True), ("two labels", True, True, False),
    ]


def test_xed_unknown_code(made):
    with pytest.raises(Exception, match="unknown label code"):
        made("XED", {"emotion.tsv": "t\t0\n", "neutral.tsv": "0\tt\n"})
