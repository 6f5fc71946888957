"""Operator 12 against the tokenizers' own libraries and sets of ends."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lakeconform.llm import alignment
from lakeconform.llm.bpe import byte_letters

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
TEXTS = [
    "The quick brown fox, unbelievably, jumps.",
    "The quick brown fox, unbelievably, jumps.",
    "",
    None,
    "naïve café 日本語のテキスト 😀😀",
    "  two  spaces\n\n\tand tabs ",
    "<|endoftext|> <s> <unk> ▁marks",
    "▁",
    "1234567890" * 40,
    "a" * 3000,
    "zero\x00byte ﬁ ㎏",
    "مرحبا بالعالم",
]


@pytest.fixture(scope="module")
def spelled():
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    letters, names = byte_letters(), {i: t for t, i in a.get_vocab().items()}

    def piece(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(letters[c] for c in names[i]) for i in ids_a]
        bytes_b = [piece(i) for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return []
        ends_a, ends_b = (np.cumsum([len(t) for t in side]) for side in (bytes_a, bytes_b))
        cuts, found, low = sorted({*ends_a.tolist()} & {*ends_b.tolist()}), [], 0
        for cut in cuts:
            found.append(
                tuple([i for i, e in zip(ids, ends) if low < e <= cut] for ids, ends in ((ids_a, ends_a), (ids_b, ends_b)))
            )
            low = cut
        return found

    return groups


def expected(spelled, texts):
    each = [spelled(t) for t in texts]
    links = [[(a, b) for ga, gb in groups for a in ga for b in gb] for groups in each]
    held = Counter(pair for pairs in links for pair in set(pairs))
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    rows = []
    for k, (groups, pairs) in enumerate(zip(each, links, strict=True)):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append(
            (
                k,
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                len(pairs),
                sum(held[p] == most[p[0]] for p in pairs),
                sum(held[p] for p in pairs),
                hashlib.sha256(text.encode()).hexdigest() if text else "",
            )
        )
    return rows


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("bound", [1 << 20, 40, 0])
def test_against_the_libraries(spelled, stored_docs, bound):
    """Whether pairs are looked up or joined, the sums are the same."""
    found = alignment.align_documents(stored_docs(TEXTS, clash=True), *PATHS, bound)
    assert sorted(map(tuple, found.select(*COLUMNS).collect())) == expected(spelled, TEXTS)


def test_shared_cuts_are_the_common_ends():
    draw = np.random.default_rng(3)
    for n in (1, 2, 7, 500, 3000):
        for share in (0.02, 0.5, 0.95):
            ends_a = np.flatnonzero(draw.random(n) < share) + 1
            ends_b = np.flatnonzero(draw.random(n) < share) + 1
            ends_a, ends_b = (np.unique([*ends, n]) for ends in (ends_a, ends_b))
            assert ends_a[alignment.shared_cuts(ends_a, ends_b)].tolist() == np.intersect1d(ends_a, ends_b).tolist()
    assert len(alignment.shared_cuts(np.zeros(0, int), np.zeros(0, int))) == 0


def test_large_groups_link_distinct_ids():
    group = np.zeros(200, np.int64)
    ids_a, ids_b = np.arange(200) % 3, np.arange(200) % 2
    _, codes, count = alignment.linked(group, group, ids_a, ids_b, 1)
    want = Counter((int(a) << 32) | int(b) for a in ids_a for b in ids_b)
    assert dict(zip(codes.tolist(), count.tolist(), strict=True)) == want
