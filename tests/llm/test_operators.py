"""Every operator against a plain version, on inputs with nulls, blanks, ties, copies and clashing columns."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import SCHEMA, documents, frame, groups, shingles, words
from tagloom.llm import (
    chat_format, curriculum, embedding_links, jaccard_join, line_templates, nearest, packing, substring_dedup, suffix_dedup, toxicity,
)
from tagloom.llm.queries import tokenizer_path
from tagloom.llm.shared import components

ROWS = documents()
KNOWN = {i: t for i, t in ROWS if i is not None}


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_components(spark):
    rnd = random.Random(1)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(0, i) for i in range(300, 340)] + [(i, i + 1) for i in range(400, 440)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = groups(pairs, {x for p in pairs if p[0] != p[1] for x in p})
    assert got == want


def test_substrings(docs, empty):
    seen, flags = {}, {}
    for i in sorted(KNOWN):
        w = words(KNOWN[i])
        for k in range(len(w) - 49):
            seen.setdefault(tuple(w[k : k + 50]), i)
    for i in KNOWN:
        w = words(KNOWN[i])
        flags[i] = [False] * len(w)
        for k in range(len(w) - 49):
            if seen[tuple(w[k : k + 50])] < i:
                flags[i][k : k + 50] = [True] * 50
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(docs).collect()}
    assert set(got) == {i for i, _ in ROWS}
    for i, f in flags.items():
        w = words(KNOWN[i])
        assert (got[i].n_words, got[i].n_removed) == (len(w), sum(f))
        assert got[i].kept == " ".join(x for x, gone in zip(w, f, strict=True) if not gone)
        assert sum(r.end - r.first for r in got[i].removed) == sum(f)
    assert sum(map(sum, flags.values())) > 1000 and got[None].n_removed == 0
    assert substring_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("shard_bytes, memory_items", [(4 << 20, 4 << 20), (3000, 500)])
def test_long_repeats(docs, empty, shard_bytes, memory_items):
    count = collections.Counter()
    data = {i: (t or "").encode() for i, t in KNOWN.items()}
    for b in data.values():
        count.update(b[k : k + 400] for k in range(len(b) - 399))
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, shard_bytes=shard_bytes, memory_items=memory_items).collect()}
    assert set(got) == {i for i, _ in ROWS}
    for i, b in data.items():
        gone = bytearray(len(b))
        for k in range(len(b) - 399):
            if count[b[k : k + 400]] > 1:
                gone[k : k + 400] = b"\1" * 400
        assert (got[i].n_bytes, got[i].n_removed) == (len(b), sum(gone))
        assert bytes(got[i].kept) == bytes(x for x, g in zip(b, gone, strict=True) if not g)
        assert len(got[i].removed) == sum(1 for part in bytes(gone).split(b"\0") if part)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_a_marker_of_many_segments_is_split(spark, monkeypatch):
    rnd = random.Random(12)
    own = lambda n: "".join(rnd.choice("abcdefghijklmnop ") for _ in range(n))
    short, passage, pair = own(100), own(440), own(700)
    rows = [(i, own(500) + (short if i % 2 else passage) + own(500)) for i in range(60)] + [(i, own(99 + i) + pair + own(i)) for i in (70, 71)]
    rows += [(80, "z" * 9000)]
    count = collections.Counter(t[k : k + 400] for _, t in rows for k in range(len(t) - 399))
    held = []
    heads = suffix_dedup.head_segments
    monkeypatch.setattr(suffix_dedup, "head_segments", lambda *a: held.append(heads(*a)) or held[-1])
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(frame(spark, rows), shard_bytes=6000).collect()}
    sizes = {r.sorts: (r.most, r.n) for r in held[0].groupBy("sorts", "marker").agg(F.sum("size").alias("size")).groupBy("sorts").agg(F.max("size").alias("most"), F.count("*").alias("n")).collect()}
    assert sizes[True][0] <= 6000 < sizes[False][0]
    for i, t in rows:
        gone = bytearray(len(t))
        for k in range(len(t) - 399):
            if count[t[k : k + 400]] > 1:
                gone[k : k + 400] = b"\1" * 400
        assert got[i].n_removed == sum(gone)
        assert bytes(got[i].kept).decode() == "".join(x for x, g in zip(t, gone, strict=True) if not g)


def test_similar_documents(docs, empty):
    sets = {i: shingles(t) for i, t in KNOWN.items()}
    ids, pairs, links = sorted(sets), [], collections.Counter()
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both / (len(sets[a]) + len(sets[b]) - both) >= 0.8:
                pairs.append((a, b))
                links[a] += 1
                links[b] += 1
    want = groups(pairs, ids)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.near_copies(docs).collect()}
    assert got == {i: (want[i], links[i]) for i in ids} | {None: (None, 0)}
    assert len(pairs) > 20 and jaccard_join.near_copies(empty).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    least = jaccard_join.least_matches()
    assert least == sorted(least)
    for n, need in zip(range(16, 65, 16), least, strict=True):
        lost = sum(math.comb(n, m) * 0.8**m * 0.2 ** (n - m) for m in range(need))
        assert lost < 1e-6


def plain_lines(rows, min_texts):
    def parse(line):
        return tuple("<*>" if any(c in "0123456789" for c in w) else w for w in words(line))

    texts, low, leaves = collections.defaultdict(set), {}, collections.defaultdict(list)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if p := parse(line):
                texts[p].add(t)
                low[p] = min(low.get(p, i), i)
    for p in texts:
        leaves[len(p), p[:3]].append(p)
    first = {}
    for lines in leaves.values():
        most = max(len(texts[p]) for p in lines)
        top = [p for p in lines if len(texts[p]) == most]
        if sum(len(texts[p]) for p in lines) < min_texts:
            continue
        assert len(top) == 1  # ties fall to a hash, which the fixture avoids
        joined = collections.defaultdict(list)
        for p in lines:
            joined[top[0] if sum(a == b for a, b in zip(p, top[0], strict=True)) / len(p) >= 0.8 else p].append(p)
        for own in joined.values():
            if sum(len(texts[p]) for p in own) >= min_texts:
                first |= {p: min(low[q] for q in own) for p in own}
    return lambda i, line: bool(parse(line)) and first.get(parse(line), i) != i


def test_line_templates(docs, empty):
    gone = plain_lines([(i, t) for i, t in ROWS if i is not None], 10)
    got = {r.doc_id: r for r in line_templates.without_recurring(docs.where("doc_id is not null"), report=True).collect()}
    removed = 0
    for i, t in KNOWN.items():
        lines = (t or "").split("\n") if t else []
        flags = [gone(i, line) for line in lines]
        removed += sum(flags)
        assert (got[i].n_lines, got[i].n_removed) == (len(lines), sum(flags))
        assert got[i].kept == ("\n".join(x for x, f in zip(lines, flags, strict=True) if not f) if any(flags) else t)
    assert removed > 10
    kept = line_templates.without_recurring(docs)
    assert kept.schema == docs.schema and kept.count() == len(ROWS)
    assert line_templates.without_recurring(empty).count() == 0


def test_variable_fields_join_a_template(spark, empty):
    rows = [(i, f"visit us at {name} street for more\nown {i} {'x' * i}") for i, name in enumerate(["oak", "elm", *["oak"] * 8, "ash", "fir"])]
    got = {r.doc_id: r.text for r in line_templates.without_recurring(frame(spark, rows)).collect()}
    assert got[0].startswith("visit us") and all(t.startswith("own") for i, t in got.items() if i)


def test_a_leaf_holds_several_templates(spark):
    names = [a + b for a in "klmnprst" for b in ("ara", "eno", "iva")]
    lines = [f"Click here to read the story by {n}" for n in names[:12]] + [f"Click here to buy all items from {n}" for n in names[:12]]
    lines += [f"Click here to win one of those {n}" for n in names[:9]]
    long = "we say that one two three four five six seven eight"
    lines += [f"{long} {a} {b} nine ten eleven" for a, b in zip(names[:11], names[1:12], strict=True)]
    rows = [(i, f"{line}\nown {'x' * i} text") for i, line in enumerate(lines)]
    got = {r.doc_id: r.text for r in line_templates.without_recurring(frame(spark, rows)).collect()}
    for i, t in rows:
        stays = i in (0, 12, 33) or 24 <= i < 33
        assert got[i] == (t if stays else t.split("\n")[1])


@pytest.mark.parametrize("holders", [2, 5, 9])
def test_a_long_line_recurs_from_two_texts_on(spark, holders):
    long, short = " ".join(f"w{k}" for k in range(60)), " ".join(f"s{k}" for k in range(49))
    rows = [(i, f"{long}\n{short}\nown {'x' * i} text") for i in range(holders)]
    other = long.replace("w7 ", "w8 ")  # only digits differ, so it is not the same word for word
    if holders < 9:  # else ten texts have the generalised line
        rows += [(20, f"{other}\nlast one"), (30, f"{other}\nlast one")]  # copies are one text
    got = {r.doc_id: r.text for r in line_templates.without_recurring(frame(spark, rows)).collect()}
    for i, t in rows:
        assert got[i] == (t if i in (0, 20, 30) else t.removeprefix(long + "\n"))


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    pieces = packing.tokenise(docs.where("doc_id is not null"), tokenizer_path())
    placed = packing.pack(pieces)
    rows = collections.defaultdict(list)
    for r in placed.collect():
        rows[r.doc_id].append(r)
    plain = Tokenizer.from_file(tokenizer_path())
    for i, t in KNOWN.items():
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(rows[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    spans = collections.defaultdict(list)
    for r in sum(rows.values(), []):
        spans[r.sequence_id].append((r.offset, r.length))
    for own in spans.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    whole = {r.sequence_id: r for r in packing.sequences(pieces, placed).collect()}
    assert set(whole) == set(spans)
    for key, own in spans.items():
        used, held = sum(n for _, n in own), len(whole[key].ids) // 4
        assert held == (used if used & (used - 1) == 0 else 2048)
    assert packing.pack(packing.tokenise(empty, tokenizer_path())).count() == 0


@pytest.mark.parametrize("text", ["", " ", "a  b", "a   b ", "x\n \n y", "tab\t b  ", "<|endoftext|> a", "it's  we'll", "\0 zero", "  lead", "  nb 　", "emoji \U0001f600  x", "a" * 5000])
def test_words_encode_like_the_whole(text):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.WordEncoder(tokenizer_path())(text), "<u4").tolist() == plain


def test_patterns_use_every_piece():
    rnd = random.Random(4)
    counts = collections.Counter(min(2048, int(rnd.expovariate(1 / 300)) + 1) for _ in range(20_000))
    patterns = packing.packing_patterns(dict(counts))
    used = collections.Counter()
    for pattern, uses in patterns:
        assert sum(pattern) <= 2048
        for length in pattern:
            used[length] += uses
    assert used == counts
    assert sum(k * n for k, n in counts.items()) / (2048 * sum(n for _, n in patterns)) > 0.98


def test_curriculum(docs, empty):
    rows = curriculum.mix(docs).collect()
    sizes = collections.defaultdict(int)
    for i, t in ROWS:
        sizes[("a", "b", None)[(i or 0) % 3]] += len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, target, free = sum(sizes.values()), {}, set(order)
    while free:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[q] for q in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        target |= {s: 3 * sizes[s] for s in over} if over else share
        free = free - over if over else set()
    taken = collections.defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-12)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert len(rows) == len(ROWS) and all(taken[s] == round(target[s]) for s in sizes)
    placed = curriculum.repeats(curriculum.mix(docs)).collect()
    assert sum(r.words for r in placed) == sum(taken.values()) and all(0 <= r.position <= 1 for r in placed)
    docs = docs.withColumns({"words": F.lit(1), "position": F.lit("p"), "placed": F.lit(0)})
    ordered = curriculum.training_order(docs)
    assert ordered.columns == docs.columns
    assert sum(len(words(r.text)) for r in ordered.collect()) == sum(taken.values())
    assert curriculum.training_order(empty).count() == 0


def test_the_mix_query_uses_the_repeats(spark, tmp_path, monkeypatch):
    from tagloom.llm.queries import QUERIES

    frame(spark, ROWS + ROWS[:3]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = QUERIES["op10_source_mixing"](spark, str(tmp_path)).collect()
    mixed = curriculum.mix(spark.read.parquet(str(tmp_path / "documents.parquet"))).collect()
    order = lambda r: (r.doc_id or 0, r.size, r.taken)
    assert sorted(map(order, rows)) == sorted(map(order, mixed))
    assert all((r.first_position is None) == (r.taken == 0) for r in rows)
    monkeypatch.setattr(curriculum, "demand_time", lambda share, drift: F.lit(0.25))
    repeats = curriculum.repeats
    monkeypatch.setattr(curriculum, "repeats", lambda m: repeats(m).withColumn("words", F.lit(7)))
    moved = QUERIES["op10_source_mixing"](spark, str(tmp_path)).where("taken > 0").collect()
    assert moved and all(r.first_position == 0.25 and r.taken % 7 == 0 for r in moved)


def test_documents_at_a_cut_stay_whole(spark):
    import corpus_pipeline

    rows = [(i, "\n".join(f"line  {i} {k}" for k in range(3 + i % 7))) for i in range(900)]
    texts = dict(rows)
    table = frame(spark, rows)
    cuts = [r for r in curriculum.mix(table).collect() if 0 < r.part_taken < r.size]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.STAGES[3][1](spark, table, "").collect()]
    assert cuts and got and all(t == texts[i] for i, t in got)
    few = frame(spark, [(i, texts[i]) for i in range(3, 9)])
    cut = [(i, t) for i, t in ((r.doc_id, r.text) for r in curriculum.training_order(few, far=0.0).collect()) if t != texts[i]]
    assert cut and all(texts[i].startswith(t) and "  " in t for i, t in cut)


def test_chats(spark):
    rnd = random.Random(2)
    pieces = ["</s>", "[INST]", "\\", "\\a", "<|end|>", "<|turn|>user\n", "\n", " ", "hi", "é漢", "\U0001f600", "<", "|", "end|>", ""]
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rnd.randint(1, 6)):
            text = None if rnd.random() < 0.1 else "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 9)))
            rows.append((conv, turn, rnd.choice(["user", "assistant", "a\nb\\z", None]), text, 9))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss int")
    formatted = chat_format.format_chats(table, tokenizer_path())
    got = {r.conv_id: r for r in chat_format.read_back(formatted).collect()}
    for conv in [*range(40), None]:
        own = sorted((t, r or "", x or "") for c, t, r, x, _ in rows if c == conv)
        whole = "".join(f"{r}\n{x}\n" for _, r, x in own)
        learned = "".join(x for _, r, x in own if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    for r in formatted.collect():
        masked = [(s, e) for s, e, m in zip(r.starts, r.ends, r.loss, strict=True) if m]
        turns = [(s, e) for s, e, t in zip(r.turn_starts, r.turn_ends, r.turn_loss, strict=True) if t]
        assert all(any(s < te and e > ts for ts, te in turns) for s, e in masked)
    assert chat_format.format_chats(table.limit(0), tokenizer_path()).count() == 0


def test_a_long_conversation_is_cut_between_turns(spark, monkeypatch):
    from tokenizers import Tokenizer

    rows = [(1, k, ("user", "assistant")[k % 2], f"turn {k}  ends\n") for k in range(50)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    text = chat_format.rendered([(r, t) for _, _, r, t in rows], "assistant")[0]
    cut = text.index(chat_format.TURN, len(text) // 2)
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    ids = lambda x: t.encode(x, add_special_tokens=False).ids
    assert ids(text[:cut]) + ids(text[cut:]) == ids(text)
    assert chat_format.read_back(chat_format.format_chats(table, tokenizer_path())).first().n_turns == 50


def vectors():
    rnd = np.random.default_rng(6)
    base = rnd.standard_normal((12, 16))
    rows = [(i, (base[i % 12] + rnd.standard_normal(16) * rnd.choice([0.05, 0.2, 1.0])).astype(np.float32).tolist()) for i in range(400)]
    rows += [(400 + i, rows[50][1]) for i in range(150)]
    odd = [None, [], [0.0] * 16, [float("nan"), *[1.0] * 15], [float("inf"), *[1.0] * 15], [None, *[1.0] * 15], [1.0, 2.0]]
    return rows, [(1000 + 50 * i, v) for i, v in enumerate(odd)]


def test_nearest(spark):
    rows, odd = vectors()
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    unit = m / np.linalg.norm(m, axis=1)[:, None]
    want = {}
    for q in ids[ids % 50 == 0]:
        score = unit @ unit[q]
        best = sorted(((-round(s, 12), i) for s, i in zip(score.tolist(), ids.tolist(), strict=True) if i != q))[:5]
        want[int(q)] = [i for _, i in best]
    got = collections.defaultdict(list)
    for r in nearest.nearest(table).orderBy("query_id", "rank").collect():
        assert abs(r.score - float(unit[r.query_id] @ unit[r.vec_id])) < 1e-12
        got[r.query_id].append(r.vec_id)
    assert got == want
    assert nearest.nearest(table.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id) for r in nearest.nearest(few).collect()] == [(0, 1, 1)]


def test_embedding_links(spark, monkeypatch):
    monkeypatch.setattr(embedding_links, "BLOCK", 100)
    rows, odd = vectors()
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    m = np.array([v for _, v in rows], float)
    unit = m / np.linalg.norm(m, axis=1)[:, None]
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    want = groups([(int(a), int(b)) for a, b in zip(*np.nonzero(close), strict=True)], range(len(rows)))
    got = {r.vec_id: r for r in embedding_links.links(table).collect()}
    for i in range(len(rows)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (int(close[i].sum()), want[i], want[i] == i)
    for i, _ in odd:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert len(got) == len(rows) + len(odd) and embedding_links.links(table.limit(0)).count() == 0


def test_gradients_of_the_network():
    import pyarrow as pa

    texts = toxicity.Texts(pa.array(["you are a bad bad fool today", "good day " * 30, "", "x"]))
    model = {k: v.astype(np.float64) for k, v in toxicity.fresh_model().items()}
    which, labels = np.arange(len(texts.text)), np.array([1.0, 0.0, 0.0, 1.0])[texts.text]

    def loss():
        vectors = toxicity.window_logits(model, texts)[which].astype(np.float64)
        return float(np.mean(np.log1p(np.exp(vectors)) - labels * vectors))

    slopes = toxicity.slopes(model, texts, which, labels)
    rnd = np.random.default_rng(0)
    for name in ("in", "in_bias", "forth", "back", "att", "att_out", "out", "bias", "grams", "words"):
        flat, slope = model[name].reshape(-1), slopes[name].reshape(-1)
        for k in rnd.choice(np.flatnonzero(np.abs(slope) > 1e-4), 3):
            kept, step = flat[k], 2e-3
            flat[k] = kept + step
            up = loss()
            flat[k] = kept - step
            down = loss()
            flat[k] = kept
            assert math.isclose((up - down) / (2 * step), slope[k], rel_tol=0.1, abs_tol=2e-4), name


def test_a_passage_lies_whole_in_a_window():
    import pyarrow as pa

    rest, passage = ["and"] * 90, [f"p{chr(97 + k)}" for k in range(20)]
    texts = toxicity.Texts(pa.array([" ".join(rest[:at] + passage + rest[at:]) for at in range(len(rest) + 1)]))
    numbers, real = texts.windows(slice(None))
    held = np.array([len(set(numbers[real[:, w], w].tolist())) for w in range(numbers.shape[1])])
    # the passage's 20 different words and, in 32, the one around it
    whole = set(texts.text[held == 21].tolist())
    assert whole == set(range(len(rest) + 1))


def test_toxicity(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "UPDATES", 150)
    rnd = random.Random(8)
    plain = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(2, 6))) for _ in range(300)]
    rows = []
    for i in range(500):
        w = [rnd.choice(plain) for _ in range(rnd.randint(5, 150))]
        if i % 5 == 0:
            for _ in range(1 + len(w) // 20):
                w.insert(rnd.randrange(len(w)), rnd.choice(["Scumbag!", "moronic", "trashy", "grumph" + rnd.choice(plain)]))
        rows.append((i, " ".join(w)))
    table = frame(spark, [*rows, (900, None), (901, ""), (902, "123 !!"), (903, " ".join(plain * 200))])
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(500)] + [(3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(table, labels).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()}
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == 504
    assert all(r.held == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [i for i in range(500) if got[i].held]
    right = sum((got[i].score >= 0.3) == (i % 5 == 0) for i in held)
    assert right / len(held) > 0.95
    assert got[900].score == got[901].score == got[902].score < 0.3
    none = toxicity.score(table, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]
    assert toxicity.score(table.limit(0), labels).count() == 0


@pytest.mark.parametrize("kinds", [[], [0], [1], [None, 2]])
def test_without_both_kinds_of_labels_nothing_is_toxic(spark, tmp_path, kinds):
    import corpus_pipeline
    from tagloom.llm.queries import QUERIES

    rows = [(i, t) for i, t in ROWS if i is not None][:30]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, kind) for kind in kinds for i, _ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = corpus_pipeline.STAGES[0][1](spark, read, str(tmp_path))
    assert kept.columns == read.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in rows}
    got = QUERIES["op1_toxicity"](spark, str(tmp_path)).collect()
    assert len(got) == 30 and all((r.score, r.predicted) == (0.0, 0) for r in got)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, t) for i, t in ROWS if i is not None]
    docs = spark.createDataFrame([(i, t, "en", ("a", "b", None)[i % 3], len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i, _ in rows[:9]], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing", "packing"]
    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    lined = corpus_pipeline.recurring_lines(spark, read, str(tmp_path))
    assert lined.schema.simpleString() == read.schema.simpleString()
    assert all(r.n_chars == len(r.text) for r in lined.where("text is not null").collect())
    alone = corpus_pipeline.near_copies(spark, read, str(tmp_path))
    classes = {r.class_id for r in jaccard_join.near_copies(read).collect()}
    assert {r.doc_id for r in alone.collect()} == classes and alone.columns == read.columns
    out = corpus_pipeline.STAGES[4][1](spark, read.limit(5), str(tmp_path))
    assert out.select("doc_id").distinct().count() == 5


@pytest.mark.parametrize("split", ["plain", "prefixed", "pieces", "lower"])
def test_words_are_encoded_as_the_tokenizer_does(tmp_path, split):
    """Random texts, and files whose way of splitting is not the plain one."""
    import json

    from tokenizers import Tokenizer

    described = json.load(open(tokenizer_path()))
    if split == "prefixed":
        described["pre_tokenizer"]["add_prefix_space"] = True
    if split == "pieces":
        described["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "Digits", "individual_digits": True}, described["pre_tokenizer"]]}
    if split == "lower":
        described["normalizer"] = {"type": "Lowercase"}
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(described))
    encoder, plain = packing.WordEncoder(str(path)), Tokenizer.from_file(str(path))
    rnd = random.Random(5)
    signs = ["a", "Be", "the", "ing", " ", "  ", "\n", "\t", "\r\n", "'s", "'LL", "don't", "1", "23", "é", "ß", "日本", "한글", "🙂", "é", " ", " ", "_", "--", "</s>", "<s>", ".", "…", "\x00", "\x1c", "​"]
    for _ in range(1500 if split == "plain" else 200):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 25)))
        assert np.frombuffer(encoder(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_learned_texts_are_bounded_by_bytes(spark):
    rows = [(i, f"text {i} " * (1 if i % 3 else 400)) for i in range(60)] + [(70, None), (71, "é" * 500)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(72)], "doc_id long, quality int, toxic int")
    texts, known = toxicity.sample_of(frame(spark, rows), labels, 100, 100, most_bytes=600)
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in range(72)]
    assert sorted(texts.to_pylist()) == sorted(t for i, t in rows if t and len(t.encode()) <= 600 and not held[i]) and len(known) == len(texts)


def test_a_turn_of_more_than_a_million_characters(spark):
    long = "word é </s> " * 100_000
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", long), (1, 2, "user", long), (1, 3, "assistant", "ok")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = chat_format.read_back(chat_format.format_chats(table, tokenizer_path())).first()
    learned = long + "ok"
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (4, len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{t}\n" for _, _, a, t in rows).encode()).hexdigest()


def test_vectors_with_clashing_columns(spark):
    rows, odd = vectors()
    names = ["packed", "block", "query_id", "rank", "score", "component_id", "n_links", "kept", "row", "length"]
    plain = spark.createDataFrame(rows[:120] + odd, "vec_id long, embedding array<float>")
    extra = plain.select("vec_id", "embedding", *[F.lit("x").alias(n) for n in names])
    for apply in (nearest.nearest, embedding_links.links):
        assert sorted(map(repr, apply(extra).collect())) == sorted(map(repr, apply(plain).collect()))


@pytest.mark.parametrize("some", [True, False])
def test_all_stages_in_sequence(spark, tmp_path, some):
    """Every stage on what the one before it kept, against plain versions; and on an empty table."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    rows = [(i, t) for i, t in ROWS if i is not None] if some else []
    frame(spark, rows, sources=("a", "b")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i, _ in rows[:9]], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, apply in corpus_pipeline.STAGES:
        docs = apply(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = kept[name] = spark.read.parquet(str(tmp_path / name))
    out = collections.Counter(tuple(r) for r in kept["packing"].select("doc_id", "start", "length", "doc_tokens").collect())
    whole = collections.Counter(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "start", "length", "doc_tokens").collect())
    assert out == whole
    if not some:
        assert not out
        return
    lined = {r.doc_id: r.text for r in kept["line dedup"].collect()}
    sets = {i: shingles(t) for i, t in lined.items()}
    ids = sorted(sets)
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and sets[a] & sets[b]
    classes = groups([(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if alike(a, b)], ids)
    alone = {r.doc_id: r.text for r in kept["n-gram Jaccard join"].collect()}
    assert alone == {i: lined[i] for i in set(classes.values())}
    mixed = collections.Counter((r.doc_id, r.text) for r in kept["mixing"].collect())
    # the document at a source's cut may give its leading words only
    cut = [(i, t) for i, t in mixed if t != alone[i]]
    assert len(cut) <= 2 and all(words(alone[i])[: len(words(t))] == words(t) for i, t in cut)
    assert max(mixed.values()) <= 3
    plain = Tokenizer.from_file(tokenizer_path())
    want = collections.Counter()
    for (i, t), n in mixed.items():
        want[i] += n * (len(plain.encode(t or "", add_special_tokens=False).ids) + 1)
    sums = collections.Counter()
    for (i, _, length, _), n in out.items():
        sums[i] += length * n
    assert sums == want


def plain_templates(rows, min_texts=10, similar=0.8):
    """First and further templates of every leaf, the most frequent line first; the operator's hash settles ties only."""
    import pyarrow as pa

    def parse(line):
        return tuple("<*>" if any(c in "0123456789" for c in w) else w for w in words(line))

    texts, low, leaves, hashes = collections.defaultdict(set), {}, collections.defaultdict(list), {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if p := parse(line):
                texts[p].add(t)
                low[p] = min(low.get(p, i), i)
                hashes[p] = int(line_templates.Lines(pa.array([line]), 3).line.view(np.int64)[0])
    for p in texts:
        leaves[len(p), p[:3]].append(p)
    agree = lambda p, q: sum(a == b for a, b in zip(p, q, strict=True)) / len(p) >= similar
    first = {}
    for lines in leaves.values():
        left = sorted(lines, key=lambda p: (len(texts[p]), hashes[p]), reverse=True)
        if sum(len(texts[p]) for p in left) < min_texts:
            continue
        at = 0
        while at < len(left):
            ball = [p for p in left if agree(p, left[at])]
            if sum(len(texts[p]) for p in ball) >= min_texts:
                first |= {p: min(low[q] for q in ball) for p in ball}
                at -= sum(p in ball for p in left[:at])
                left = [p for p in left if p not in ball]
            else:
                at += 1  # it stands alone, but may join a later one
    return lambda i, line: bool(parse(line)) and first.get(parse(line), i) != i


@pytest.mark.parametrize("most", [None, (5, 3)])
def test_further_templates_by_brute_force(spark, monkeypatch, most):
    """In one task a set, and dealt out over slices of five lines with three tried in a round."""
    if most:
        monkeypatch.setattr(line_templates, "SET_LINES", most[0])
        monkeypatch.setattr(line_templates, "HEADS", most[1])
    rnd = random.Random(21)
    names = [a + b for a in "klmnprstvz" for b in ("ara", "eno", "iva", "uso")]
    heads = ["click here to", "we say that", "in all of"]
    patterns = [rnd.choice(heads).split() + [rnd.choice(["read", "buy", "win", "see", "the", "for"]) for _ in range(rnd.randint(2, 9))] for _ in range(14)]
    lines = []
    for pattern in patterns:
        for _ in range(rnd.randint(4, 30)):
            w = list(pattern)
            for _ in range(rnd.choice([0, 1, 1, 1, 2, 3])):
                w[rnd.randrange(3, len(w))] = rnd.choice(names)
            lines.append(" ".join(w))
    rows = [(i, f"{line}\nown {'x' * (i + 1)} text") for i, line in enumerate(lines)]
    got = {r.doc_id: r.text for r in line_templates.without_recurring(frame(spark, rows)).collect()}
    gone = plain_templates(rows)
    want = {i: "\n".join(x for x in t.split("\n") if not gone(i, x)) for i, t in rows}
    assert got == want and sum(want[i] != t for i, t in rows) > 60


def test_a_leaf_of_many_lines_is_many_tasks(spark, monkeypatch):
    """Lines of one leaf that do not agree are not brought together."""
    rnd = random.Random(22)
    pick = lambda: "".join(rnd.choice("bcdfghjklm") for _ in range(6))
    lines = [f"click here to {pick()} {pick()} {pick()} {pick()} {pick()}" for _ in range(3000)]
    lines += [f"click here to {a} the {b} story now" for a in ("read", "hear") for b in [pick() for _ in range(12)]]
    rows = [(i, f"{line}\nown {'x' * 3} {i}") for i, line in enumerate(lines)]
    sizes = []
    monkeypatch.setattr(line_templates, "components", lambda edges: sizes.append(components(edges)) or sizes[-1])
    got = {r.doc_id: r.text for r in line_templates.without_recurring(frame(spark, rows)).collect()}
    assert max(r["count"] for r in sizes[0].groupBy("component").count().collect()) <= 24
    changed = {i for i, t in rows if got[i] != t and not got[i].startswith("click")}
    assert changed == set(range(3001, 3024)) - {3012} or changed == set(range(3001, 3024))


def test_the_texts_to_learn_from_stay_off_the_driver(spark, monkeypatch):
    rows = [(i, f"{'awful nasty word' if i % 3 == 0 else 'plain kind word'} {i}") for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    texts, known = toxicity.sample_of(table, labels, 100, 100)
    own = toxicity.trained(texts, known)

    def refused(*_):
        raise AssertionError("texts brought to the driver")

    monkeypatch.setattr(type(table), "toArrow", refused)
    sent = toxicity.fitted(toxicity.sample_rows(table, labels, 100, 100))
    assert own.keys() == sent.keys() and all(np.allclose(own[k], sent[k], atol=1e-3) for k in own)
    assert toxicity.fitted(toxicity.sample_rows(table, labels.where("toxic = 0"), 100, 100)) is None
    assert toxicity.score(table, labels).count() == 60
