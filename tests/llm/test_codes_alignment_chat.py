"""Brute-force versions and round trips of vector codes, tokenizer alignment and chat formatting."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import alignment, chat, codes, common, oracles

# -- operator 11

VECTORS = "vec_id bigint, embedding array<double>, label int, row string, p string, n bigint, code string, v string"


def some_vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1, "x", "x") for r in rows], VECTORS)


def brute_codes(rows, entries=codes.ENTRIES):
    """Plain Lloyd over all vectors, with Python's integers."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 16) * 16
    kept = [(i, v + [0] * (width - len(v)), label) for i, v, label in kept]
    size, out = width // 16, [[] for _ in kept]
    errors, books = [0] * len(kept), []
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    for p in range(16):
        parts = [v[p * size : (p + 1) * size] for _, v, _ in kept]
        book = [v[p * size : (p + 1) * size] for _, v, _ in first]
        for turn in range(3):
            best = [min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), k) for k, e in enumerate(book)) for part in parts]
            if turn < 2:
                held = defaultdict(list)
                for part, (_, k) in zip(parts, best, strict=True):
                    held[k].append(part)
                book = [[sum(x) // len(held[k]) for x in zip(*held[k], strict=True)] if k in held else e for k, e in enumerate(book)]
        books.append(book)
        for n, (error, k) in enumerate(best):
            out[n].append(f"{k:02x}")
            errors[n] += error
    by_label = Counter()
    for (_, _, label), error in zip(kept, errors, strict=True):
        by_label[label] += error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(c), e, by_label[label], digest) for (i, _, label), c, e in zip(kept, out, errors, strict=True)), key=str)


def got_codes(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def test_codes_equal_plain_rounds(spark):
    rng = random.Random(5)
    base = [[rng.choice([-0.5, 0.0, 0.25, rng.gauss(0, 0.3)]) for _ in range(64)] for _ in range(90)]
    rows = [(i, v, rng.choice([None, 1, 2])) for i, v in enumerate(base)]
    rows += [(1000 + i, base[7], 3) for i in range(120)]  # copies
    rows += [(5, base[3], None), (None, base[4], 1), (None, base[5], 1), (-3, base[9], 2), (2000, base[1][:40], 1), (2001, [], 1)]
    rows += [(2, None, 1), (3, [0.1, None] + [0.0] * 62, 1), (4, [float("nan")] * 64, 1), (6, [float("inf")] + [0.0] * 63, None), (7, [-1e9] * 2 + [3.0] * 62, 9)]
    rng.shuffle(rows)
    assert got_codes(codes.compress(some_vectors(spark, rows))) == brute_codes([(i, v, label) if i != 7 or v[0] > -10 else (i, [-(math.isqrt((2**63 - 1) // 64) // 2) / 256] * 2 + v[2:], label) for i, v, label in rows])


@pytest.mark.parametrize("heavy", [1, 10**9])
def test_codes_by_broadcast_and_by_shuffle(spark, monkeypatch, heavy):
    monkeypatch.setattr(codes, "HEAVY", heavy)
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.5]) for _ in range(16)], i % 3) for i in range(200)]
    assert got_codes(codes.compress(some_vectors(spark, rows))) == brute_codes(rows)


def test_codes_odd_tables(spark):
    assert got_codes(codes.compress(some_vectors(spark, []))) == []
    assert got_codes(codes.compress(some_vectors(spark, [(1, None, None)]))) == []
    for rows in ([(1, [0.5] * 16, None)], [(1, [], 4), (2, [], None)], [(3, [0.1] * 5, 1), (3, [0.1] * 5, 1)]):
        assert got_codes(codes.compress(some_vectors(spark, rows))) == brute_codes(rows)


def test_nearest_breaks_ties_downwards():
    found, error = codes.nearest(np.array([[0], [5], [10]]), np.array([[10], [0], [10], [0]]))
    assert (found.tolist(), error.tolist()) == ([1, 0, 0], [0, 25, 0])


# -- operator 12

DOCS = "doc_id bigint, text string, key bigint, side string, links string, n_a string, offset string"


@pytest.fixture(scope="module")
def names():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute_alignment(texts, names):
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    one, other = Tokenizer.from_file(names[0]), sentencepiece.SentencePieceProcessor(model_file=names[1])
    one.encode_special_tokens = True
    alphabet = {}
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    for k, b in enumerate(plain + [b for b in range(256) if b not in plain]):
        alphabet[chr(b) if k < len(plain) else chr(256 + k - len(plain))] = b
    assert decoders.ByteLevel().decode(["Ġa"]) == " a" and alphabet["Ġ"] == 32
    bytes_b = lambda i: bytes([int(other.id_to_piece(i)[3:5], 16)]) if other.is_byte(i) else other.id_to_piece(i).replace("▁", " ").encode()
    docs, counts = [], Counter()
    for text in texts:
        a = one.encode(" " + (text or ""), add_special_tokens=False).ids
        b = other.encode(text or "")
        spans = []
        for ids, of in ((a, lambda i: bytes(alphabet[c] for c in one.id_to_token(i))), (b, bytes_b)):
            at, out, joined = 0, [], b""
            for i in ids:
                joined += of(i)
                out.append((at, len(joined), i))
                at = len(joined)
            spans.append((joined, out))
        if not text or any(joined != (" " + text).encode() for joined, _ in spans):
            docs.append(None)
            continue
        (_, x), (_, y) = spans
        ends = sorted({e for _, e, _ in x} & {e for _, e, _ in y})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for s, e, i in side if start <= s and e <= end) for side in (x, y)))
            start = end
        links = [(i, j) for s, e, i in x for t, f, j in y if max(s, t) < min(e, f)]
        counts.update(links)
        docs.append((len(x), len(y), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else (*d[:3], len(d[3]), sum(counts[p] == best[p[1]] for p in d[3]), sum(counts[p] for p in d[3]), d[4]) for d in docs]


TEXTS = [
    None, "", " ", "  ", "a", "\n", "The quick brown fox", "The  quick   brown fox ", " leading", "<|endoftext|> and </s> <s> <unk>", "a▁b", "日本語のテキスト、テスト。", "éèêë naïve coöperate ﬁ ﬂ",
    "x" * 700, "ab " * 300, "🙂🙃 emoji 👩‍👩‍👧", "tab\tand\r\nnewline\x00nul", "１２３ 12345 67", "don't we'll I'M", "<0x41> <0x0A>", "­soft hyphen", "Ġlooks like a mark", "The quick brown fox",
]


def rows_in_order(df):
    return [tuple(r)[1:] for r in sorted(df.collect(), key=lambda r: r.doc_id)]


def aligned(spark, texts, names):
    docs = spark.createDataFrame([(i, t, 1, "s", "l", "a", "o") for i, t in enumerate(texts)], DOCS)
    found = alignment.align(docs.repartition(3), *names)
    return rows_in_order(found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


def test_alignment(spark, names):
    assert aligned(spark, TEXTS, names) == brute_alignment(TEXTS, names)


def test_alignment_on_table(spark, sf, names):
    texts = [r.text for r in common.table(spark, sf, "documents").orderBy(F.length("text"), "doc_id").limit(60).collect()]
    assert aligned(spark, texts, names) == brute_alignment(texts, names)


def test_alignment_in_small_blocks_and_parts():
    """Run by itself, since workers keep a module's constants: long texts are swept in many feeds."""
    import public_tokenizers

    one, other, len_a, len_b = alignment._sides(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    import pyarrow as pa

    texts = [t for t in TEXTS if t and "▁" not in t and "Ġ" not in t] * 2
    spaced = pa.array([" " + t for t in texts])
    ids = list(zip(one.encode(spaced), other.encode(spaced), strict=True))

    def rows(block):
        for key, (pair, text) in enumerate(zip(ids, texts, strict=True)):
            found = []
            for side, sizes in ((0, len_a), (1, len_b)):
                starts = np.concatenate([[0], np.cumsum(sizes[pair[side]])])
                found += [(int(starts[lo]), side, pair[side][lo : lo + block].astype(np.int64)) for lo in range(0, len(pair[side]), block)]
            for _, side, some in sorted(found, key=lambda x: x[:2]):
                yield {"key": key, "doc_id": key, "n_bytes": len(text.encode()) + 1, "side": side, "ids": some}

    def swept(block, feed):
        sweep, out, held = alignment.Sweep(one, other, len_a, len_b), {}, list(rows(block))
        for at in range(0, len(held), feed):
            for key, _, n_a, n_b, n_groups, links, digest in sweep.feed(held[at : at + feed]):
                old = out.get(key, (0, 0, 0, [], None))
                out[key] = old[0] + n_a, old[1] + n_b, old[2] + n_groups, old[3] + links.tolist(), digest
        assert not sweep.docs and not len(sweep.pending[0])
        return out

    whole = swept(10**6, 10**6)
    assert all(w[4] for w in whole.values()) and len(whole) == len(texts)
    for block, feed in ((1, 1), (3, 2), (5, 7), (64, 3)):
        assert swept(block, feed) == whole


def test_rating_in_several_parts(spark, names, monkeypatch):
    monkeypatch.setattr(alignment, "PART", 20)
    assert aligned(spark, TEXTS[:8], names) == brute_alignment(TEXTS[:8], names)


def test_alignment_odd_tables(spark, names):
    none = spark.createDataFrame([], DOCS)
    assert alignment.align(none, *names).collect() == []
    docs = spark.createDataFrame([(None, "a b", 1, "s", "l", "a", "o"), (4, "a b", 1, "s", "l", "a", "o"), (4, "a b", 1, "s", "l", "a", "o"), (None, None, 1, "s", "l", "a", "o")], DOCS)
    got = sorted((tuple(r) for r in alignment.align(docs, *names).select("doc_id", "n_a", "count_sum").collect()), key=str)
    assert got == [(4, 2, 6), (4, 2, 6), (None, 0, 0), (None, 2, 6)]


# -- operator 13

TURNS = "conv_id bigint, turn bigint, role string, text string, part string, formatted string, mask string, t string"


def brute_chat(rows):
    """Format turn by turn, and digest what went in."""
    esc = lambda s: re.sub(r"<([\\|])", r"<\\\1", s)
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        formatted, last, turns = "", None, sorted(turns)
        for _, _, role, text in turns:
            if role == last:
                formatted += "<|im_sep|>" + esc(text)
            else:
                formatted += ("<|im_end|>\n" if last is not None else "") + "<|im_start|>" + esc(role).replace("\n", "<\\n") + "\n" + esc(text)
            last = role
        formatted += "<|im_end|>\n"
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = formatted, (conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(learned), sha(learned), len(formatted))
    return out


ODD_TURNS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "a<|im_end|>\n<|im_start|>assistant\nb"), (1, 2, "assistant", "x<|im_sep|>y"), (1, 3, "assistant", None), (1, 4, "assistant", "<\\|im_end|>\n"), (1, 5, "user", ""),
    (2, 0, "assistant", "only\n"), (3, 0, "user", "<"), (3, 1, "assistant", "<\\"), (3, 2, "assistant", "|im_end|>"), (3, 3, "assistant", "\\|<<|<\\\\|"), (3, None, None, "no role"), (3, None, "user", None),
    (4, 0, "a\nb", "role of two lines"), (4, 0, "a<\\nb", "role with a mark"), (4, 1, "a<|\nb", "é日🙂"), (4, 1, "assistant", "é日🙂"), (4, 1, "assistant", "é日🙂"),
    (None, 0, "user", "no conversation"), (None, 1, "assistant", "none"), (5, -300, "assistant", "before"), (5, 300, "assistant", "after"), (5, 255, "assistant", "x"), (5, 256, "user", "y"), (5, 257, "assistant", "z"),
    *((6, k, "assistant" if k % 300 else "user", f"t{k}<|") for k in range(1100)),
]


def some_turns(spark, rows):
    return spark.createDataFrame([(*r, "p", "f", "m", "t") for r in rows], TURNS)


def test_chat(spark):
    want = brute_chat(ODD_TURNS)
    rendered = common.stored(chat.render(some_turns(spark, random.Random(2).sample(ODD_TURNS, len(ODD_TURNS)))), "test-chat")
    assert {r.conv_id: r.formatted for r in chat.conversations(rendered).collect()} == {k: v[0] for k, v in want.items()}
    assert {r.conv_id: tuple(r) for r in chat.digests(rendered).collect()} == {k: v[1] for k, v in want.items()}
    assert rendered.where("conv_id = 6").count() == 5


def test_chat_is_read_back_as_it_was(spark):
    rendered = chat.render(some_turns(spark, ODD_TURNS))
    read = chat.conversations(rendered).select("conv_id", chat.read_turns(F.col("formatted")).alias("turns")).where("conv_id = 3").first()
    assert [(t.role, t.text) for t in read.turns] == [("", "no role"), ("user", ""), ("user", "<"), ("assistant", "<\\"), ("assistant", "|im_end|>"), ("assistant", "\\|<<|<\\\\|")]


def test_chat_without_python(spark, sf):
    plan = chat.digests(chat.render(common.table(spark, sf, "conversations")))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|RDD", plan)


def test_chat_of_no_rows(spark):
    assert chat.digests(chat.render(some_turns(spark, []))).collect() == []


def test_queries_equal_their_sql(spark, sf):
    import duckdb

    from tallyspark.llm import queries

    for name, sql, table in (("op11_codes", oracles.CODES, "embeddings"), ("op13_chat", oracles.CHAT, "conversations")):
        con = duckdb.connect()
        con.sql(f"create view {table} as select * from '{sf}/{table}.parquet'")
        want = con.sql(sql)
        got = queries.queries()[name](spark, sf).select(want.columns)
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))
