import sys
import zlib
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

from starmart.llm import tokens  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, very long and repeated texts, a null id, and columns with clashing names."""
    texts = [
        None,
        "",
        " \n\t ",
        "12 34 !?",
        "one two three",
        "one two three",
        "The cat sat on the mat and the dog lay by the door.",
        "word " * 30_000,
        "x" * 200_000,
        "Été à la plage, où l'on rêve. 日本語 😀",
    ]
    rows = [(i, text, "en" if i % 2 else None, "s", len(text or ""), 7) for i, text in enumerate(texts)]
    rows += [rows[4], (None, "one two three", None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score int"
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("1 = 0")


@pytest.fixture(scope="session")
def plain_ids():
    """Ids of whole texts by the tokenizer itself, the end id included."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.default_tokenizer())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.fixture(scope="session")
def crc_of():
    return lambda ids: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
