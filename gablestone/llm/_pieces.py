"""Pieces of a text that a byte-level BPE tokenizer encodes independently of one another.

A tokenizer of this family never joins a character that is no white space with white space after
it, and a letter or digit never with a full stop or comma that white space or the end follows. The
text is cut there only, so that the tokens of the pieces in a row are the tokens of the text. Most
pieces are words that come again, and are encoded once a worker."""

from __future__ import annotations

import json
import re

#: White space as Unicode has it (White_Space).
WS = r"\t-\r \x85\xa0  -     　"
PIECE = re.compile(rf"[{WS}]*[^\W\d_]+(?=[,.](?:[{WS}]|\Z))|[{WS}]*[^{WS}]+|[{WS}]+")
#: Memoised pieces of a worker; beyond that the memo starts anew.
MEMO = 700_000

#: White space other than single spaces and line ends.
_RARE = re.compile(r"[\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: A full stop or comma, with a space behind it, that follows no letter or digit.
_LOOSE = re.compile(r"[,.] (?<=[\W_][,.] )")


def _plain(text: str) -> bool:
    if not text or text[0] in " ,.\n" or text[-1] == " ":
        return False
    if any(x in text for x in ("  ", "\n\n", " \n", "\n ", " ,", " .")):
        return False
    rare = any(x in text for x in "\t\x0b\x0c\r") if text.isascii() else _RARE.search(text)
    return not rare and not _LOOSE.search(text)


def keys(text: str) -> list:
    """Keys of the pieces of a text in order. A plain text is split at its spaces; a word stands for
    itself with a space before it, but for ",", "." and words that begin with a line end, which
    stand for themselves, as does the content of a tuple."""
    if not _plain(text):
        return [(p,) for p in PIECE.findall(text)]
    found = text.replace("\n", " \n").replace(", ", " , ").replace(". ", " . ").split(" ")
    found[0] = (found[0],)
    return found


def piece(key) -> str:
    """The piece that a key stands for."""
    if type(key) is tuple:
        return key[0]
    return key if key in _BARE or key[0] == "\n" else " " + key


_BARE = frozenset(",.")
_SPACES = frozenset("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def JOINABLE(piece: str) -> bool:
    """Whether it can be encoded in a row with others like it: the row is cut between them."""
    return piece[0] in _SPACES and piece[-1] not in _SPACES


def splits_anywhere(tokenizer_file: str) -> bool:
    """Whether the cuts hold: byte-level splitting by the usual pattern, no normalizer, and added
    tokens that are matched as they are and hold no white space."""
    with open(tokenizer_file) as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    added = [t for t in spec.get("added_tokens", []) if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(rf"[{WS}.,]", t["content"])]
    plain = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    return plain and not added and spec["model"]["type"] == "BPE"


class Numbers(dict):
    """Numbers of pieces, in the order of their first use; those not yet asked for are listed in new."""

    def __missing__(self, piece):
        self[piece] = k = len(self)
        self.new.append(piece)
        return k
