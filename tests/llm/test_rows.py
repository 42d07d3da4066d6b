"""Language ID, quality, audio, chat."""

import hashlib
import json
import re
import struct
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
import regex

from conftest_llm import make_docs
from tidemark.llm import audio, chat, language, quality
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    truth = {row.doc_id: row.lang for row in table(spark, SF, "documents").collect()}
    rows = QUERIES["op1_language_id"](spark, SF).collect()
    assert len(rows) == len(truth)
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
    held = [row for row in rows if row.held_out]
    assert sum(row.lang_pred == truth[row.doc_id] for row in held) >= 0.99 * len(held)
    assert sum(row.rejected for row in rows) <= 0.01 * len(rows)


def test_language_rejects_far_texts(spark):
    model = language.fit(table(spark, SF, "documents"))
    odd = make_docs(spark, [(1, "漢字 仮名 交じり 文 " * 20, None), (2, "привет как дела " * 30, None)])
    assert [row.rejected for row in language.predict(odd, model).collect()] == [True, True]


def test_language_edges(spark, edge_docs, empty_docs):
    model = language.fit(edge_docs)
    rows = language.predict(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    for row in rows:
        letterless = not any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred == "und") == letterless
        assert not letterless or (row.rejected and row.score == 0)
    assert language.fit(empty_docs) is None
    assert {row.lang_pred for row in language.predict(edge_docs, None).collect()} == {"und"}
    assert language.predict(empty_docs, model).collect() == []
    kept = language.predict(edge_docs, model, ("p", "q", "z")).collect()
    assert {row.score for row in kept} == {"x"}  # the input's own column


def slow_grams(text):
    """Counts of hashed 1- to 3-grams with plain integers."""
    letters = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text.lower())
    if not letters.strip(" "):
        return None
    points = [ord(c) for c in " " + re.sub(" +", " ", letters).lstrip(" ") + " "]
    wrap, counts = 0xFFFFFFFF, [0] * language.DIMS
    pairs = [(a * 0x9E3779B1 + b) & wrap for a, b in zip(points, points[1:])]
    triples = [(a * 0x85EBCA6B + c) & wrap for a, c in zip(pairs, points[2:])]
    for salt, grams in ((1, points[1:-1]), (2, pairs), (3, triples)):
        for gram in grams:
            mixed = ((gram ^ (salt * 0x27D4EB2F & wrap)) * 0xC2B2AE35) & wrap
            mixed ^= mixed >> 15
            counts[((mixed * 0x165667B1) & wrap) >> 20] += 1
    return counts


def slow_unit(vector):
    length = sum(x * x for x in vector) ** 0.5
    return [x / length for x in vector] if length else vector


def test_language_equals_brute_force(spark):
    """Vectors, centroids, cosines and rejections in plain Python."""
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents").limit(60)
    rows = [(r.doc_id, r.text[:4000], r.lang) for r in docs.collect()]
    rows += [(10**6, rows[0][1], rows[0][2])] * 30 + [(10**6 + 1, "", "en"), (10**6 + 2, "123 !", "fr"), (10**6 + 3, "Ünïcödé  x", None)]
    frame = make_docs(spark, rows)
    model = language.fit(frame, per_language=2, sample_rows=10**6)
    training = [(d, t, lang) for d, t, lang in rows if zlib.crc32(str(d).encode()) % 4 != 2 and lang and t is not None]
    grams = {t: slow_grams(t) for _, t, _ in rows}
    for text, counts in grams.items():
        found = language.gram_counts(text)
        assert (found is None) == (counts is None) and (counts is None or found.tolist() == counts)
    counted = [(d, t, lang) for d, t, lang in training if grams[t]]
    frequency = [sum(grams[t][k] > 0 for _, t, _ in counted) for k in range(language.DIMS)]
    idf = [float(np.log((1 + len(counted)) / (1 + f)) + 1) for f in frequency]
    assert model.idf.tolist() == pytest.approx(idf, rel=1e-5)
    vector = {t: slow_unit([float(np.log1p(n)) * w for n, w in zip(counts, idf)]) for t, counts in grams.items() if counts}
    dot = lambda a, b: float(np.dot(a, b))
    names, centres = [], []
    for lang in sorted({lang for *_, lang in counted}):
        firsts = {}
        for d, t, other in counted:
            if other == lang:
                firsts[t] = min(d, firsts.get(t, d))
        points = [vector[t] for t, _ in sorted(firsts.items(), key=lambda item: item[1])]
        found = [slow_unit(np.mean(points, axis=0).tolist())]
        while len(found) < min(2, len(points)):
            found.append(min(points, key=lambda p: max(dot(p, c) for c in found)))
        for _ in range(12):
            member = [max(range(len(found)), key=lambda k: dot(p, found[k])) for p in points]
            moved = [slow_unit(np.sum([p for p, m in zip(points, member) if m == k], axis=0).tolist()) if k in member else found[k] for k in range(len(found))]
            done = np.allclose(moved, found)
            if done:
                break
            found = moved
        names += [lang] * len(found)
        centres += found
    assert model.languages == names and np.allclose(model.matrix, centres, atol=2e-3)
    for row in language.predict(frame, model).collect():
        counts = grams[row.text]
        if counts is None:
            assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
            continue
        cosines = [dot(vector[row.text], c) for c in model.matrix.tolist()]
        assert row.score == pytest.approx(max(0.0, min(1.0, max(cosines))), abs=1e-4)
        assert max(c for c, name in zip(cosines, names) if name == row.lang_pred) >= max(cosines) - 1e-4
        limit = model.thresholds[int(np.log2(sum(counts)))]
        assert row.rejected == (row.score <= 0 or row.score < limit) or abs(row.score - limit) < 1e-4


def test_language_bounds(spark):
    rows = [(k, f"text number {k} of many", f"l{k}") for k in range(40)]
    with pytest.raises(ValueError, match="more than 8"):
        language.fit(make_docs(spark, rows), most_languages=8)
    assert language.predict(make_docs(spark, rows), language.fit(make_docs(spark, rows))).count() == 40


def brute_quality(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    covered = {p for k, w in enumerate(windows) if windows.count(w) > 1 for p in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def test_quality(spark, edge_rows, empty_docs):
    repeated = "one two three four five six seven eight nine\n" * 3 + "and something else that comes after it once"
    rows = [(d, t, lang) for d, t, lang in edge_rows if len(t or "") < 5000]
    rows += [(20, repeated, "en"), (21, "a b a b a b a b a b a b a b a b a b a b a b a b", None), (22, "w%%% " * 40, None), (23, "Home | News | About\n" + "good words in a line. " * 6, None)]
    got = sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.measure(make_docs(spark, rows)).collect())
    assert got == sorted((d or 0, *brute_quality(t)) for d, t, _ in rows)
    assert quality.measure(empty_docs).collect() == []


def test_quality_verdicts(spark):
    clean = " ".join(f"word{k}" for k in range(60)) + "."
    rows = [(1, clean, None), (2, clean + "\nAll rights reserved.", None), (3, "\n".join(f"w{k}%%% v{k}*** u{k}$$$" for k in range(20)), None), (4, "Home | News\n" + clean, None)]
    got = {r.doc_id: (r.kept, r.clean_text) for r in quality.measure(make_docs(spark, rows)).collect()}
    assert got == {1: (True, clean), 2: (True, clean), 3: (False, ""), 4: (True, clean)}


def slow_line_fails(line):
    visible = len(re.sub(r"[\x20\x09-\x0D]", "", line))
    letters = sum(unicodedata.category(c)[0] == "L" for c in line)
    symbols = sum(c in "#*$%&|<>" for c in line)
    menu = sum(c in "|>»›" for c in line) >= 2 or visible <= 300 and regex.match(rf"[ \t]*(?:{quality.NAVIGATION})(?!\p{{L}})", line.lower())
    notice = len(line) - len(re.sub(quality.BOILERPLATE, "", line.lower()))
    return visible > 0 and bool(10 * symbols > visible or 2 * letters < visible or menu and len(line.split()) <= 12 or visible <= 300 and 10 * notice >= visible)


def test_quality_long(spark, edge_docs, edge_rows):
    """Very long texts: the figures, the verdict and the cleaned text against plain Python."""
    got = sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.base_failed, r.kept, r.lost_chars, r.clean_text) for r in quality.measure(edge_docs).collect())
    want = []
    for d, t, _ in edge_rows:
        text = t or ""
        words, lines = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w], text.split("\n")
        windows = Counter(zip(*(words[k:] for k in range(8))))
        covered = {p for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for p in range(k, k + 8)}
        good, filled = [x for x in lines if not slow_line_fails(x)], [x for x in lines if x.strip(" \t\n\x0b\x0c\r")]
        chars = sum(map(len, words))
        clean = text if len(good) == len(lines) else "\n".join(good)
        lost = chars - len(re.sub(r"[\x20\x09-\x0D]", "", clean))
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        want.append((d or 0, len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), len(filled) - len(set(filled)), failed, not failed and lost <= 0.5 * chars, lost, clean))
    assert got == sorted(want)


def test_quality_phrases_in_four_languages(spark):
    long = " ".join(f"good{k} words" for k in range(40))
    notices = ["Alle Rechte vorbehalten. Impressum", "Tous droits réservés", "Política de privacidad | Aviso legal", "© 2024 Somebody", "Please accept cookies to go on.", "Startseite", "Lire la suite", "Menú"]
    rows = [(k, f"{long}\n{line}", None) for k, line in enumerate(notices)]
    # One phrase inside a long line, and words that only look like phrases, cost nothing.
    other, more = (" ".join(f"{word}{'xyz'[k % 3] * (k // 3 + 1)}" for k in range(40)) for word in ("fine", "fair"))
    fair = [f"{other} cookie {more}", f"{other} all rights reserved {more}", "She baked a cookie, and the menus were printed on paper.", "The copyright of it was long disputed in the courts of that country."]
    rows += [(100 + k, f"{long}\n{line}", None) for k, line in enumerate(fair)]
    got = {r.doc_id: (r.kept, r.clean_text) for r in quality.measure(make_docs(spark, rows)).collect()}
    assert {k: got[k] for k in range(len(notices))} == {k: (True, long) for k in range(len(notices))}
    assert {k: got[k] for k in got if k >= 100} == {100 + k: (True, f"{long}\n{line}") for k, line in enumerate(fair)}


def slow_adpcm(block):
    sample = int.from_bytes(block[:2], "little", signed=True)
    index, out = min(block[2], 88), [sample]
    for byte in block[4:]:
        for nibble in (byte & 15, byte >> 4):
            step = int(audio._STEPS[index])
            change = (step >> 3) + (step if nibble & 4 else 0) + (step >> 1 if nibble & 2 else 0) + (step >> 2 if nibble & 1 else 0)
            sample = max(-32768, min(32767, sample + (-change if nibble & 8 else change)))
            index = max(0, min(88, index + int(audio._INDEX_MOVES[nibble & 7])))
            out.append(sample)
    return out


def test_audio_decoders():
    raw = np.random.default_rng(1).integers(0, 256, 64 * 50).astype(np.uint8)
    assert audio.decode_adpcm(raw).tolist() == [slow_adpcm(bytes(block)) for block in raw.reshape(-1, 64)]
    mu, a = audio.mu_law_table(), audio.a_law_table()
    assert (mu[0], mu[0x80], mu[0x7F], mu[0xFF]) == (-32124, 32124, 0, 0)
    assert (a[0x55], a[0xD5], a[0x2A], a[0xAA]) == (-8, 8, -32256, 32256)
    pcm = np.full(40, 1000, np.int16)
    assert audio.resample_double(pcm).tolist() == [1000] * 80


def test_audio_rejects_other_bytes():
    with pytest.raises(ValueError):
        audio.unpack(b"RIFFxxxxAVI ")
    with pytest.raises(ValueError):
        audio.unpack(audio.pack(bytes(64), audio.MU_LAW).replace(b"fmt \x12\x00\x00\x00\x07", b"fmt \x12\x00\x00\x00\x01"))


def test_audio_rows(spark, edge_docs, edge_rows, empty_docs):
    rows = audio.read_media(audio.store_payloads(edge_docs)).collect()
    assert len(rows) == len(edge_rows)
    texts = sorted(((t or "").encode() for _, t, _ in edge_rows))
    assert sorted(bytes(r.payload)[: r.n_bytes] for r in rows) == texts
    for r in rows:
        assert len(r.payload) % 64 == 0 and len(r.payload) >= 64 and not any(bytes(r.payload)[r.n_bytes :])
        assert zlib.crc32(bytes(r.pcm)) == int(r.feature.split(":")[-1], 16)
    assert audio.read_media(audio.store_payloads(empty_docs)).collect() == []


def slow_law(codec, byte):
    """One sample by the companding rules, bit by bit."""
    if codec == audio.MU_LAW:
        code = ~byte & 255
        size = ((code & 15) * 2 + 33) * 4 * 2 ** (code >> 4 & 7) - 132
        return -size if code & 128 else size
    code = byte ^ 0x55
    segment, size = code >> 4 & 7, (code & 15) * 16 + 8
    size = size if segment == 0 else (size + 256) * 2 ** (segment - 1)
    return size if code & 128 else -size


def slow_media(payload):
    """The stored form and the feature of a payload: container, samples, resampling and figures in plain Python."""
    codec = (audio.A_LAW, audio.MU_LAW, audio.IMA_ADPCM)[zlib.crc32(payload) % 3]
    if codec == audio.IMA_ADPCM:
        pcm = [x for at in range(0, len(payload), 64) for x in slow_adpcm(payload[at : at + 64])]
        form = struct.pack("<HHIIHHHH", codec, 1, 8000, 8000 * 64 // 121, 64, 4, 2, 121)
    else:
        pcm = [slow_law(codec, byte) for byte in payload]
        form = struct.pack("<HHIIHHH", codec, 1, 8000, 8000, 1, 8, 0)
    chunks = b"fmt " + struct.pack("<I", len(form)) + form + b"fact" + struct.pack("<II", 4, len(pcm)) + b"data" + struct.pack("<I", len(payload)) + payload
    media = b"RIFF" + struct.pack("<I", len(chunks) + 4) + b"WAVE" + chunks
    padded, wide = [pcm[0]] * 3 + pcm + [pcm[-1]] * 4, []
    for k, sample in enumerate(pcm):
        between = sum(padded[k + j] * int(weight) >> 2 for j, weight in enumerate(audio._HALFWAY))
        wide += [sample, max(-32768, min(32767, between + 4096 >> 13))]
    loud = (sum(x * x for x in pcm) / len(pcm)) ** 0.5
    crossings = sum((a < 0) != (b < 0) for a, b in zip(pcm, pcm[1:]))
    name = {audio.A_LAW: "alaw", audio.MU_LAW: "mulaw", audio.IMA_ADPCM: "adpcm"}[codec]
    return media, f"{name}:{len(pcm)}:{max(map(abs, pcm))}:{loud:.2f}:{crossings}:{zlib.crc32(struct.pack(f'<{len(wide)}h', *wide)):08x}"


def test_audio_query(spark):
    docs = {r.doc_id: r.text.encode() for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    for r in QUERIES["op6_telephony_audio"](spark, "/root/testdata/sf0.001").collect():
        raw = docs[r.doc_id]
        if r.doc_id % 5 == 0:
            media, feature = slow_media(raw + bytes(-len(raw) % 64 if raw else 64))
            assert (r.media_bytes, r.media_sha256, r.feature) == (len(media), hashlib.sha256(media).hexdigest(), feature)
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))


def test_chat_round_trip():
    turns = [("user", r"\### Assistant: </turn> ok"), ("assistant", "### user:\n</turn>\n\\\\"), ("a:\nb#<\\", ""), ("", "\n"), ("assistant", "x" * 50_000 + "\\" * 9)]
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    with pytest.raises(ValueError):
        chat.parse(formatted + "x")


def test_chat_layouts(spark):
    records = [
        (1, {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, [("user", "a"), ("assistant", "b")]),
        (2, {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, [("user", "a"), ("assistant", "b")]),
        (3, {"instruction": "a", "input": "c", "output": "b"}, [("user", "a\nc"), ("assistant", "b")]),
        (4, {"prompt": "a", "completion": None}, [("user", "a"), ("assistant", "")]),
        (5, {"turns": [{"speaker": {"name": "bot"}, "text": "b"}]}, [("assistant", "b")]),
        (6, {"messages": []}, []),
        (7, {"unheard": 1}, None),
    ]
    df = spark.createDataFrame([(k, json.dumps(r)) for k, r, _ in records] + [(8, "not json"), (9, None)], "key bigint, record string")
    got = {r.key: chat.parse(r.formatted) if r.known else None for r in chat.format_records(df).collect()}
    assert got == {k: turns for k, _, turns in records} | {8: None, 9: None}
    assert sorted((r.layout is None, r.n) for r in chat.unknown_layouts(chat.format_records(df)).collect()) == [(False, 1), (True, 2)]


def brute_chat(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns = [(role, text) for _, _, role, text in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
    return out


def test_chat_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "🎉"), (2, None, None, "x"), (None, 3, "assistant", ""), (1, 1, "assistant", "🎉"), (3, 0, "system", "\x00\u2028"), (4, 0, "user\nassistant", "x"), (5, 0, "human", "a"), (5, 1, "gpt", "b")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'x' key", "'x' record")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.format_records(chat.rows_to_records(df))).collect()}
    assert got == brute_chat(rows)
    assert chat.read_back(chat.format_records(chat.rows_to_records(df.limit(0)))).collect() == []


def test_chat_query(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, k, role, r"\### Assistant: </turn> ok") for k, role in enumerate(("user", "assistant"))]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in QUERIES["op10_chat_format"](spark, SF).collect()}
    assert got == brute_chat(rows)
