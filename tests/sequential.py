"""The operators' rules as statements about positions in whole texts, for small inputs.

A stream is first joined to its contiguous stretches.  Where a stretch may be cut follows from
the whole stretch up to the end of each chunk; what is expected are the pieces between cuts.
"""

import re
from itertools import islice, pairwise

WORD_END = set(" .,;:!?-—\t\n\r\f\v")
TOKEN = re.compile(r"[^\W_]+|[\W_]")


def tail_start(data):
    """Where an incomplete last character begins; None if no character could look so."""
    i = len(data)
    while i and 0x80 <= data[i - 1] < 0xC0:
        i -= 1
    if i == 0:
        return 0
    behind, lead = len(data) - i, data[i - 1]
    if behind > 3:
        return None
    needed = 0 if lead < 0x80 else 1 if 0xC0 <= lead < 0xE0 else 2 if 0xE0 <= lead < 0xF0 else 3 if 0xF0 <= lead < 0xF8 else -1
    return len(data) if needed == behind else i - 1


def width(payload):
    return len(payload.encode()) if isinstance(payload, str) else len(payload)


def stretches(chunks):
    """``(start, payloads)`` of every run of adjacent chunks ``(payload, start)``."""
    firsts = [i for i, (_, start) in enumerate(chunks) if i == 0 or start != chunks[i - 1][1] + width(chunks[i - 1][0])]
    for a, b in pairwise([*firsts, len(chunks)]):
        yield chunks[a][1], [payload for payload, _ in chunks[a:b]]


def pieces(text, start, cuts):
    """The text between cuts, which are positions in it, with byte offsets."""
    at = [start + width(text[:c]) for c in cuts]
    return [(text[a:b], x, y) for (a, b), (x, y) in zip(pairwise(cuts), pairwise(at)) if a < b]


def whole_until(data):
    """The end of the last whole character; bytes that begin none are an error."""
    try:
        return len(data.decode()) and len(data)
    except UnicodeDecodeError as error:
        if error.reason != "unexpected end of data":
            raise
        return error.start


def decode(chunks):
    """A stretch that starts within a text loses what is left of its first character.

    The bytes lost do not move it, so what follows them in the object is no neighbour of it.
    """
    short, end = [], 0
    for data, start in chunks:
        short.append((data if start == end else data.lstrip(bytes(range(0x80, 0xC0))), start))
        end = start + len(short[-1][0])
    out = []
    for start, parts in stretches(short):
        data = b"".join(parts)
        ends = [sum(map(len, parts[: i + 1])) for i in range(len(parts))]
        cuts = [0, *(whole_until(data[:e]) for e in ends)]
        out += [(text.decode(), a, b) for text, a, b in pieces(data, start, cuts)]
    return out


def heal(chunks, marks=WORD_END):
    """Chunks are (text, start, end); words stay whole, and the rest of one that began before goes."""
    out = []
    for start, parts in stretches([(text, start) for text, start, _ in chunks]):
        text = "".join(parts)
        ends = [sum(map(len, parts[: i + 1])) for i in range(len(parts))]
        cuts = [0]
        for e in ends:
            # Behind the last mark since the cut before; without one the chunk stays whole.
            cuts.append(max((i + 1 for i in range(cuts[-1], e) if text[i] in marks), default=e))
        found = pieces(text, start, cuts)
        opening = next((i for i, c in enumerate(parts[0]) if c in marks), 0)
        if start and opening:
            piece, _, end = found[0]
            found[0] = (piece[opening:], start + opening, end)  # moves on by characters
        out += [f for f in found if not f[0].isspace()]
    return out


def word_ends(text, a, b):
    """Ends of the tokens of ``text[a:b]``."""
    return (m.end() for m in TOKEN.finditer(text, a, b))


def resize(chunks, low, high, marks=".!?\n", token_ends=word_ends):
    """Chunks are (text, start).  No token reaches over a seam.

    Ends of chunks and of windows are seams; a window that is cut early takes its seams along.
    """
    out = []
    for start, parts in stretches(chunks):
        text, cuts, seams, end = "".join(parts), [0], set(), 0
        for part in parts:
            end += len(part)
            seams = {s for s in seams if s > cuts[-1]} | {end}
            while True:
                edges = [cuts[-1], *sorted(s for s in seams if cuts[-1] < s <= end)]
                window = list(islice((e for a, b in pairwise(edges) for e in token_ends(text, a, b)), high))
                if len(window) < low:
                    break
                sentence = 1 + max(text.rfind(m, cuts[-1], window[-1]) for m in marks)
                if sentence > cuts[-1] and len(list(islice(token_ends(text, cuts[-1], sentence), low))) == low:
                    seams = {s for s in seams if not sentence < s < window[-1]} | {window[-1]}
                    cuts.append(sentence)
                else:
                    cuts.append(window[-1])
        out += pieces(text, start, cuts)
    return out
