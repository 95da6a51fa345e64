import hashlib

from awkward import AWKWARD
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stridelake.llm.bpe import Bpe, default_path, digests, encoded

LIBRARY = Tokenizer.from_file(default_path())
LIBRARY.no_truncation()
LIBRARY.no_padding()
OURS = Bpe(default_path())
#: Code points up to Unicode 15; what later versions added is treated as the library's version does only by chance.
LETTERS = st.characters(max_codepoint=0xD7FF, exclude_categories=["Cn", "Cs"]) | st.sampled_from("\U0001f600\U0001f468‍")
PIECES = st.sampled_from(["<|startoftext|>", "<|endoftext|>", "<|", "'s", "'LL", "ΣΑΣ", "İ", "ﬁ", "é", "é", "  ", "\n", "aaaa", "½", "١٢"])


def library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(LETTERS, max_size=12) | PIECES, max_size=12).map("".join))
def test_any_text_like_the_library(text):
    ids = OURS.encode([text])[0]
    assert (ids.tolist(), OURS.decode(ids)) == library(text)


def test_documents_like_the_library(spark, docs_of, texts):
    rows = [(i, t) for i, t, _ in texts] + AWKWARD + [(13, "a" * 30_000)]
    got = sorted((tuple(r) for r in digests(docs_of(rows)).collect()), key=str)

    def row(i, t):
        ids, text = library(t or "")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text)]
        return i, len(ids), *sha

    assert got == sorted((row(i, t) for i, t in rows), key=str)


def test_columns_stay_and_results_replace(docs_of):
    docs = docs_of(AWKWARD[:4])
    out = encoded(docs)
    assert sorted(out.columns) == sorted([*docs.columns, "decoded"])
    assert encoded(docs.limit(0)).count() == 0 and all(not r["ids"] for r in out.where("doc_id IN (7, 8)").collect())
