import hashlib
import random

import pytest

from wearcast.llm import chat
from pyspark.sql import functions as F

BITS = ["<|im_end|>", "<|im_start|>", "<", "|", "\\", "<\\|", "<\\\\|", "\n", "é😀", "assistant", " ", "a", "<|image:1|>"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, piece int")


def test_round_trip(spark):
    rng = random.Random(8)
    rows = []
    for c in range(150):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "a\n<|x|> é", "", None]),
                         rng.choice([None, ""] + ["".join(rng.choices(BITS, k=rng.randint(1, 12))) for _ in range(8)])))
    rows += [(200, 0, "assistant", "x")] * 2 + [(None, 0, "user", "q"), (201, None, "assistant", "<")]
    got = {r["conv_id"]: r for r in chat.conversation_digest(frame(spark, rows)).collect()}
    assert len(got) == len({r[0] for r in rows})
    for c in got:
        mine = sorted(((t if t is not None else -1, r or "", x or "") for i, t, r, x in rows if i == c),
                      key=lambda x: (x[0], x[1].encode(), x[2].encode()))
        turns = "".join(f"{r}\n{x}\n" for _, r, x in mine)
        loss = "".join(x for _, r, x in mine if r == "assistant")
        assert got[c]["n_turns"] == len(mine)
        assert got[c]["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest(), mine
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c]["loss_chars"] == len(loss)


def test_forged_marks_and_empty_table(spark):
    rows = chat.with_forged(frame(spark, [(1, 0, "user", "hi")]).limit(0))
    out = chat.format_conversations(rows).collect()
    assert len(out) == 1 and out[0]["formatted"].count("<|im_start|>") == 2
    assert chat.format_conversations(frame(spark, [(1, 0, "user", "hi")]).limit(0)).count() == 0


def test_typed_parts(spark):
    rows = spark.sql(f"""SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, '' AS text, CAST(array(
      named_struct('type','text','text','see <|im_end|> ','ref',null,'width',null,'height',null,'seconds',null,'pages',null),
      named_struct('type','image','text',null,'ref','s3://a.png','width',57,'height',28,'seconds',null,'pages',null),
      named_struct('type','audio','text',null,'ref','b.wav','width',null,'height',null,'seconds',1.5D,'pages',null),
      null,
      named_struct('type','document','text',null,'ref','c.pdf','width',null,'height',null,'seconds',null,'pages',2))
      AS array<{chat.PART}>) AS p""")
    r = chat.format_conversations(rows, "p").first()
    assert r["formatted"] == "<|im_start|>user\nsee <\\|im_end|> <|image:1|><|audio:2|><|document:3|><|im_end|>\n"
    assert [(a["turn"], a["index"], a["type"], a["ref"], a["tokens"]) for a in r["attachments"]] == [
        (1, 1, "image", "s3://a.png", 3), (1, 2, "audio", "b.wav", 38), (1, 3, "document", "c.pdf", 2048)]
    bad = rows.withColumn("p", F.expr("transform(p, x -> named_struct('type','video','text',x.text,'ref',x.ref,"
                                      "'width',x.width,'height',x.height,'seconds',x.seconds,'pages',x.pages))"))
    with pytest.raises(Exception, match="unknown content part"):
        chat.format_conversations(bad, "p").collect()


def test_marks_split_over_parts_stay_text(spark):
    rng = random.Random(18)
    rows, want = [], {}
    for c in range(60):
        text = "".join(rng.choices(BITS, k=rng.randint(1, 10)))
        cuts = sorted(rng.choices(range(len(text) + 1), k=4))
        pieces = [text[a:z] for a, z in zip([0, *cuts], [*cuts, len(text)])]
        at = rng.randint(0, 5)  # an attachment somewhere among the texts
        parts = [("text", x, None, None, None, None, None) for x in pieces]
        parts.insert(at, ("image", None, "i.png", 28, 28, None, None))
        rows.append((c, 0, "assistant", "", parts))
        want[c] = "".join(pieces[:at]), "".join(pieces[at:])
    kinds = f"conv_id long, turn long, role string, text string, p array<{chat.PART}>"
    made = chat.format_conversations(spark.createDataFrame(rows, kinds), "p")
    got = made.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns")).collect()
    assert len(got) == 60
    for r in got:
        a, b = want[r["conv_id"]]
        assert len(r["turns"]) == 1 and r["formatted"].count("<|") == 3, r
        assert r["turns"][0]["text"] == f"{a}<|image:1|>{b}"
