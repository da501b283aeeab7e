import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from linkledger.llm import packing
from linkledger.llm.packing import pack, plan_slots, tokenizer_path

from .cases import no_docs, odd_docs, odd_rows


def test_pieces_are_the_tokenizers_ids_in_gapless_sequences(spark):
    tok = Tokenizer.from_file(tokenizer_path())
    want = []
    for key, text, *_ in odd_rows():
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        want += [(key, k, at, len(ids[at:at + 4096]), zlib.crc32(np.array(ids[at:at + 4096], "<u4").tobytes()))
                 for k, at in enumerate(range(0, len(ids), 4096))]
    got = pack(odd_docs(spark)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(by) == -(-sum(w[3] for w in want) // 4096)


def odd_text(rng):
    parts = ["foo", "Bar", "don't", "O'Neil's", "a1b22", ",", ".-", "'", "''s", "|", "<|endoftext|>", "<|ENDOFTEXT|>", "x<|",
             "\x01", "\x01\x01", "é", "É", "e\u0301", "=\u0338", "\u0338", "×", "a÷b", "ß", "İ", "Σ", "œ", "«", "日本", "\xa0", "\u2003",
             "\x1c", "\x0b", "\x85", "\u200d", "😀", "\r", "\x00", "K", "'S", "'ll", "İ'", "\ufb01"]
    return "".join(rng.choice(parts) + rng.choice(["", "", "", " ", "\n", "\t"]) for _ in range(rng.randint(0, 25)))


def test_words_between_blanks_and_signs_have_the_ids_of_whole_texts(monkeypatch):
    tok = Tokenizer.from_file(tokenizer_path())
    monkeypatch.setattr(packing, "REMEMBERED", 40)
    monkeypatch.setattr(packing, "JOINED", 7)
    known = packing.WordIds(tok)
    rng = random.Random(8)
    for _ in range(400):
        texts = [odd_text(rng) for _ in range(rng.randint(1, 6))]
        ids, ends = packing.text_ids([t.encode() for t in texts], known, 1)
        got = [part.tolist() for part in np.split(ids, ends[:-1])]
        assert got == [tok.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert len(known.young) <= 40 + 100 and known.old


def plain_best_fit(lengths, room):
    free = []
    for n in sorted(lengths, reverse=True):
        fit = [k for k, f in enumerate(free) if f >= n]
        if fit:
            free[min(fit, key=lambda k: free[k])] -= n
        else:
            free.append(room - n)
    return len(free)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(3)
    for _ in range(60):
        room = rng.choice([7, 20, 64])
        lengths = [rng.randint(1, room - 1) for _ in range(rng.randint(0, 200))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        used, ranks = {}, {}
        for n, lo, hi, first, offset in plan_slots(counts, room):
            ranks.setdefault(n, []).extend(range(lo, hi))
            for k in range(hi - lo):
                used.setdefault(first + k, []).append((offset, n))
        assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
        assert sorted(used) == list(range(len(used)))
        for places in used.values():
            end = 0
            for offset, n in sorted(places):
                assert offset == end
                end += n
            assert end <= room
        assert len(used) == plain_best_fit(lengths, room)


def test_empty_table(spark):
    assert pack(no_docs(spark)).count() == 0
