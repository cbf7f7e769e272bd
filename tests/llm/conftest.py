import pytest


@pytest.fixture(scope="session")
def llm(spark):
    """The session with the package given to its workers."""
    from posting_analytics.llm.common import ship_code
    ship_code(spark)
    return spark


@pytest.fixture(scope="session")
def docs_of(llm):
    """A documents table from ``(doc_id, text)`` or ``(doc_id, text, source)`` rows, with clashing extra columns."""
    def make(rows):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or ""), "x", 7, 0.5) for r in rows]
        return llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                         "size string, shard int, score double")
    return make


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def space_words(text):
    """Words `[^\\x20\\x09-\\x0D]+`."""
    out, word = [], ""
    for c in text or "":
        if c == " " or "\t" <= c <= "\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out + [word] if word else out
