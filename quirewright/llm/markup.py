"""Markup residue in recognised blocks: which families a block holds, and its clean text.

A document (one result's blocks in order) is read as a sequence of leaves: tags, comments, character references and the
text between them, line by line, each with the open tags above it. A bidirectional LSTM in numpy reads tag-path and
hashed-word vectors of all leaves of the document; a block has a family if the network says so of one of its leaves.
Words are hashed as they are, signs with what stands beside them; no pattern names a mark. The network is trained here,
from a fixed seed, on documents made by a generator that knows the families of each block; its weights have a fixed size.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from html.entities import html5
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAMILIES = ("html", "markdown", "wiki", "latex")
#: Sizes of the hashed vectors of signs with tag paths and of words, and of the network's state.
MARK_SLOTS, WORD_SLOTS, STATE = 768, 64, 24
WIDTH = MARK_SLOTS + WORD_SLOTS + 2
#: Documents made for training, passes over them, and the seed.
TRAINING_DOCUMENTS, PASSES, SEED = 3_000, 5, 7
#: Leaves whose vectors are held at once; the states go on from one such stretch to the next, so that it bounds memory alone.
STRETCH = 4_096
#: Probability from which a family is a block's.
THRESHOLD = 0.5

#: Names of HTML elements, old ones and a wiki's own included. Fixed values.
_TAGS = "a abbr address article aside b big blockquote br button caption center cite code col colgroup dd del details div dl dt em figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i img input ins kbd label li link main mark math meta mi mn mo mrow msub msup nav ol option p pre q ref s samp script section select small span strike strong style sub summary sup table tbody td tfoot th thead title tr tt u ul var video nowiki gallery".split()
_TAG = rf"</?(?:{'|'.join(_TAGS)})(?:\s[^<>]*|/)?\s*/?>"
_VOID = frozenset("br hr img input meta link col".split())
_MATH_LATEX = re.compile(r"\\[a-zA-Z]+|\^\{|_\{|\^\w|\w_\w")


# leaves

_LEAF = re.compile(r"<!--[\s\S]*?(?:-->|\Z)|<[!?][^<>]*>|</?([a-zA-Z][a-zA-Z0-9]*)(?=[\s/>])[^<>]*>|&(#\d{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[a-zA-Z][a-zA-Z0-9]*;?)|\n")
_COMBINING = "".join(chr(n) for n in range(0x300, 0xFE30) if unicodedata.category(chr(n))[0] == "M")
_TOKEN = re.compile(rf"((?:[^\W\d_]|[{_COMBINING}])+)|(\d+)|([^\S\n]+)|((.)\5*)")
_BARE_REFERENCES = frozenset(n for n in html5 if not n.endswith(";") and len(n) <= 4 and n.islower())
_slots: dict[str, int] = {}


def _slot(text: str, size: int = MARK_SLOTS) -> int:
    """A feature's slot; remembered, and forgotten when the memory is full."""
    at = _slots.get(text)
    if at is None:
        if len(_slots) > 200_000:
            _slots.clear()
        at = _slots[text] = zlib.crc32(text.encode("utf-8", "surrogatepass")) % size
    return at


def _word_slot(word: str) -> int:
    at = _slots.get("word " + word)
    if at is None:
        at = _slots["word " + word] = MARK_SLOTS + zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_SLOTS
    return at


def _line_features(line: str, slots: list[int], weights: list[float]) -> None:
    """Slots of a line's words, and of its runs of a sign with what stands on either side."""
    tokens = [(m.lastindex, m[0]) for m in _TOKEN.finditer(line)]
    words = 0
    before, first = "^", len(slots)
    for k, (kind, text) in enumerate(tokens):
        following = tokens[k + 1] if k + 1 < len(tokens) else (0, "")
        behind = "$wds+"[following[0] if following[0] < 4 else 4]
        if kind == 1:
            slots.append(_word_slot(text.lower()))
            weights.append(0.0)
            words += 1
            before = "w"
        elif kind == 2:
            before = "d"
        elif kind == 3:
            before = "s" if before != "^" else "^"
        else:
            run = text if len(text) < 5 else text[:4] + "+"
            beside = following[1].lower() if following[0] == 1 and len(following[1]) < 16 else following[1][:2] if following[0] == 4 else behind
            for feature in (f"{before}{run}{behind}", f"{run}>{beside}", run):
                slots.append(_slot(feature))
                weights.append(0.5)
            before = "+"
    scale = 1 / (1 + words) ** 0.5
    for k in range(first, len(slots)):
        if not weights[k]:
            weights[k] = scale


def leaf_vectors(block: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leaves of a block as (leaf, slot, weight) triples in order of the leaves; the last leaf's number is the greatest."""
    leaves: list[int] = []
    slots: list[int] = []
    weights: list[float] = []
    open_tags: list[str] = []
    above: dict[int, int] = {}  # slots of the open tags, however many
    n = 0

    def leaf(kind: str, line: str | None = None, name: str | None = None) -> None:
        nonlocal n
        at = len(slots)
        slots.append(_slot("kind " + kind))
        weights.append(1.0)
        if name is not None:
            slots.append(_slot("name " + name))
            weights.append(1.0)
        if open_tags:
            slots.append(_slot("parent " + open_tags[-1]))
            weights.append(0.5)
            for s in above:
                slots.append(s)
                weights.append(0.25)
        if line is not None:
            _line_features(line, slots, weights)
        leaves.extend([n] * (len(slots) - at))
        n += 1

    def text(a: int, z: int) -> None:
        if z > a and not block[a:z].isspace():
            leaf("text", block[a:z])

    done = 0
    for m in _LEAF.finditer(block):
        if m[0] == "\n":
            text(done, m.start())
        elif m[2]:
            known = m[2].startswith("#") or (m[2] in html5 if m[2].endswith(";") else m[2] in _BARE_REFERENCES)
            if not known:
                continue  # part of the text
            text(done, m.start())
            leaf("reference", name=m[2].rstrip(";").lower() if m[2][0] != "#" else "#")
        elif m[1]:
            name = m[1].lower()
            kind = ("close " if m[0][1] == "/" else "open ") + ("element" if name in _ELEMENTS else "other")
            text(done, m.start())
            leaf(kind, name=name)
            if m[0][1] != "/" and name not in _VOID and not m[0].endswith("/>"):
                open_tags.append(name)
                s = _slot("above " + name)
                above[s] = above.get(s, 0) + 1
            elif m[0][1] == "/" and above.get(_slot("above " + name)):
                while open_tags:
                    gone = open_tags.pop()
                    s = _slot("above " + gone)
                    above[s] -= 1
                    if not above[s]:
                        del above[s]
                    if gone == name:
                        break
        else:
            text(done, m.start())
            leaf("comment" if m[0].startswith("<!--") else "declaration")
        done = m.end()
    text(done, len(block))
    if not n:
        leaf("text", "")
    leaves += [0, n - 1]
    slots += [WIDTH - 2, WIDTH - 1]  # first and last leaf of the block
    weights += [1.0, 1.0]
    return np.array(leaves, np.int64), np.array(slots, np.int64), np.array(weights, np.float32)


_ELEMENTS = frozenset(_TAGS)


class Leaves:
    """The leaves of one document's blocks; dense rows are made a stretch at a time."""

    def __init__(self, blocks: list[str]):
        found = [leaf_vectors(b) for b in blocks]
        self.sizes = np.array([f[0].max() + 1 for f in found], np.int64)
        first = np.cumsum(self.sizes) - self.sizes
        leaf = np.concatenate([f[0] + a for f, a in zip(found, first)])
        order = np.argsort(leaf, kind="stable")
        self.leaf = leaf[order]
        self.slot = np.concatenate([f[1] for f in found])[order]
        self.weight = np.concatenate([f[2] for f in found])[order]
        self.owner = np.repeat(np.arange(len(blocks)), self.sizes)

    def __len__(self) -> int:
        return len(self.owner)

    def rows(self, a: int, z: int) -> np.ndarray:
        lo, hi = np.searchsorted(self.leaf, [a, z])
        flat = np.bincount((self.leaf[lo:hi] - a) * WIDTH + self.slot[lo:hi], self.weight[lo:hi], (z - a) * WIDTH)
        return np.minimum(flat, 3).astype(np.float32).reshape(z - a, WIDTH)


# the network


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over leaves with one sigmoid for each family."""

    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)
        d = WIDTH
        self.p = {}
        for side in "fb":
            self.p[f"{side}x"] = r.normal(0, d**-0.5, (d, 4 * STATE)).astype(np.float32)
            self.p[f"{side}h"] = r.normal(0, STATE**-0.5, (STATE, 4 * STATE)).astype(np.float32)
            b = np.zeros(4 * STATE, np.float32)
            b[STATE : 2 * STATE] = 1
            self.p[f"{side}b"] = b
        self.p["o"] = r.normal(0, STATE**-0.5, (2 * STATE, len(FAMILIES))).astype(np.float32)
        self.p["s"] = np.zeros((d, len(FAMILIES)), np.float32)  # the leaf itself, past the states
        self.p["c"] = np.full(len(FAMILIES), -1, np.float32)

    def _run(self, side: str, x: np.ndarray, mask: np.ndarray, keep: list | None, state: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
        n, steps, _ = x.shape
        h, c = state or (np.zeros((n, STATE), np.float32), np.zeros((n, STATE), np.float32))
        out = np.zeros((n, steps, STATE), np.float32)
        xw = x @ self.p[f"{side}x"] + self.p[f"{side}b"]
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = xw[:, t] + h @ self.p[f"{side}h"]
            i, f, o = (_sigmoid(z[:, k * STATE : (k + 1) * STATE]) for k in range(3))
            g = np.tanh(z[:, 3 * STATE :])
            m = mask[:, t, None]
            new = m * (f * c + i * g) + (1 - m) * c
            th = np.tanh(new)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, th, m))
            h = m * (o * th) + (1 - m) * h
            c = new
            out[:, t] = h
        return out, (h, c)

    def logits(self, documents: list[Leaves]) -> list[np.ndarray]:
        """A row of the families' logits for each leaf of each document; the documents are best of like length."""
        steps = max(map(len, documents))
        parts = [(a, min(steps, a + STRETCH)) for a in range(0, steps, STRETCH)]

        def stretch(a: int, z: int) -> tuple[np.ndarray, np.ndarray]:
            return _padded([d.rows(min(a, len(d)), min(z, len(d))) for d in documents], z - a)

        out = np.zeros((len(documents), steps, len(FAMILIES)), np.float32)
        for side, o, order in (("f", self.p["o"][:STATE], parts), ("b", self.p["o"][STATE:], parts[::-1])):
            state = None
            for a, z in order:
                x, mask = stretch(a, z)
                h, state = self._run(side, x, mask, None, state)
                out[:, a:z] += h @ o + (x @ self.p["s"] + self.p["c"] if side == "f" else 0)
        return [out[k, : len(d)] for k, d in enumerate(documents)]

    def gradients(self, x: np.ndarray, mask: np.ndarray, owner: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients where ``owner`` numbers the block of each leaf (-1 for padding) and ``y`` has a row for each block.

        A block's logit is the greatest of its leaves', so that its family is learnt where its marks are.
        """
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self._run("f", x, mask, kept["f"])[0], self._run("b", x, mask, kept["b"])[0]], 2)
        z = (states @ self.p["o"] + x @ self.p["s"] + self.p["c"]).reshape(-1, len(FAMILIES))
        flat_owner = owner.reshape(-1)
        real = flat_owner >= 0
        top = np.full((len(y), len(FAMILIES)), -1e9, z.dtype)
        np.maximum.at(top, flat_owner[real], z[real])
        p = _sigmoid(top)
        loss = -float((y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7)).sum()) / len(y)
        chosen = np.zeros_like(z)
        chosen[real] = z[real] == top[flat_owner[real]]
        d = np.zeros_like(z)
        d[real] = chosen[real] * ((p - y) / len(y))[flat_owner[real]]
        flat = d
        d = d.reshape(*x.shape[:2], len(FAMILIES))
        g = {"o": states.reshape(-1, 2 * STATE).T @ flat, "s": x.reshape(-1, x.shape[2]).T @ flat, "c": flat.sum(0)}
        back = d @ self.p["o"].T
        for side, part in (("f", back[:, :, :STATE]), ("b", back[:, :, STATE:])):
            wh = self.p[f"{side}h"]
            dz_all = np.zeros((*x.shape[:2], 4 * STATE), np.float32)
            gh = np.zeros_like(wh)
            dh, dc = np.zeros((len(x), STATE), np.float32), np.zeros((len(x), STATE), np.float32)
            for t, h0, c0, i, f, o, gg, th, mm in reversed(kept[side]):
                a = part[:, t] + dh
                da = mm * a
                dnew = dc + da * o * (1 - th * th)
                dn = mm * dnew
                dz = np.concatenate([dn * gg * i * (1 - i), dn * c0 * f * (1 - f), da * th * o * (1 - o), dn * i * (1 - gg * gg)], 1)
                dz_all[:, t] = dz
                gh += h0.T @ dz
                dh = dz @ wh.T + (1 - mm) * a
                dc = dn * f + (1 - mm) * dnew
            flat = dz_all.reshape(-1, 4 * STATE)
            g[f"{side}x"], g[f"{side}h"], g[f"{side}b"] = x.reshape(-1, x.shape[2]).T @ flat, gh, flat.sum(0)
        return loss, g


def _padded(sequences: list[np.ndarray], steps: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((len(sequences), steps, sequences[0].shape[1]), np.float32)
    mask = np.zeros((len(sequences), steps), np.float32)
    for k, s in enumerate(sequences):
        x[k, : len(s)] = s
        mask[k, : len(s)] = 1
    return x, mask


@lru_cache(maxsize=2)
def trained(documents: int = TRAINING_DOCUMENTS, passes: int = PASSES, seed: int = SEED) -> Labeller:
    """The network trained on ``documents`` made documents; the same weights every time."""
    from quirewright.llm.markup_samples import sample_document

    r = np.random.default_rng(seed)
    leaves, labels = [], []
    for _ in range(documents):
        blocks = sample_document(r)
        leaves.append(Leaves([text for text, _ in blocks]))
        labels.append(np.array([[f in families for f in FAMILIES] for _, families in blocks], np.float32))
    net = Labeller(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v2 = {k: np.zeros_like(v) for k, v in net.p.items()}
    step, steps = 0, passes * -(-documents // 32)
    by_length = sorted(range(documents), key=lambda k: len(leaves[k]))
    batches = [by_length[at : at + 32] for at in range(0, documents, 32)]
    for _ in range(passes):
        for k in r.permutation(len(batches)):
            part = batches[k]
            x, mask = _padded([leaves[k].rows(0, len(leaves[k])) for k in part], max(len(leaves[k]) for k in part))
            owner = np.full(mask.shape, -1, np.int64)
            blocks = 0
            for row, k in enumerate(part):
                owner[row, : len(leaves[k])] = leaves[k].owner + blocks
                blocks += len(labels[k])
            _, g = net.gradients(x, mask, owner, np.concatenate([labels[k] for k in part]))
            norm = max(1.0, float(np.sqrt(sum(float((a * a).sum()) for a in g.values()))))
            step += 1
            rate = 0.03 * min(1.0, step / 20) * (1 - step / (steps + 1)) ** 0.7
            for k, a in g.items():
                a = a / norm
                m[k] = 0.9 * m[k] + 0.1 * a
                v2[k] = 0.99 * v2[k] + 0.01 * a * a
                net.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def label_documents(net: Labeller, documents: list[list[str]]) -> list[list[list[str]]]:
    """Families of each block of each document; documents of like length are read side by side."""
    made = [Leaves(blocks) for blocks in documents]
    out: list[list[list[str]]] = [[] for _ in documents]
    order = sorted(range(len(made)), key=lambda k: len(made[k]))
    least = np.log(THRESHOLD / (1 - THRESHOLD))
    at = 0
    while at < len(order):
        # side by side only while padding and rows stay within a stretch
        z = at + 1
        while z < len(order) and z - at < 32 and (z - at + 1) * len(made[order[z]]) <= STRETCH:
            z += 1
        part = order[at:z]
        for k, logits in zip(part, net.logits([made[k] for k in part])):
            best = np.full((len(documents[k]), len(FAMILIES)), -np.inf, np.float32)
            np.maximum.at(best, made[k].owner, logits)
            out[k] = [[f for f, q in zip(FAMILIES, row) if q >= least] for row in best]
        at = z
    return out


# clean text


class _Renderer(HTMLParser):
    """HTML as plain lines: headings, list items, rows of cells, code and formulas keep a form of their own."""

    _BLOCK = frozenset("p div section article header footer ul ol table tr blockquote pre h1 h2 h3 h4 h5 h6 figure figcaption center caption dl dt dd tbody thead hr".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.lists: list[list] = []
        self.skip = self.code = 0
        self.cells = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("style", "script"):
            self.skip += 1
        elif tag in ("td", "th"):
            self.out.append(" | " if self.cells else "")
            self.cells += 1
        elif tag == "br":
            self.out.append("\n")
        elif tag == "li":
            kind = self.lists[-1] if self.lists else ["ul", 0]
            kind[1] += 1
            self.out.append("\n" + "  " * max(0, len(self.lists) - 1) + (f"{kind[1]}. " if kind[0] == "ol" else "- "))
        elif tag == "math":
            self.out.append("\x02")
        elif tag in self._BLOCK:
            self.out.append("\n")
            if tag in ("ul", "ol"):
                self.lists.append([tag, 0])
            elif tag == "tr":
                self.cells = 0
            elif tag[0] == "h" and tag[1:].isdigit():
                self.out.append("#" * int(tag[1:]) + " ")
            elif tag == "pre":
                self.code += 1

    def handle_endtag(self, tag):
        if tag in ("style", "script"):
            self.skip = max(0, self.skip - 1)
        elif tag == "math":
            self.out.append("\x03")
        elif tag in self._BLOCK:
            if tag in ("ul", "ol") and self.lists:
                self.lists.pop()
            elif tag == "pre":
                self.code = max(0, self.code - 1)
            self.out.append("\n")

    def handle_data(self, data):
        if not self.skip:
            if self.code:
                data = "\n" + "\n".join("    " + x for x in data.strip("\n").split("\n")) + "\n"
            elif self.cells == 0 or data.strip():
                data = re.sub(r"[ \t]*\n[ \t]*", "\n", data)
            self.out.append(data)


def clean_text(text: str | None, families: list[str]) -> str | None:
    """A block without the marks of ``families``: headings as ``# ``, items as ``- ``, cells between `` | ``, code indented by four, formulas as LaTeX between ``$``.

    Null stays null. Text of no family is only trimmed. Escaped HTML is decoded once and read as HTML if it then is.
    """
    if text is None:
        return None
    held: list[str] = []

    def hold(s: str) -> str:
        held.append(s)
        return f"\x00{len(held) - 1}\x01"

    t = text.replace("\x00", "").replace("\x01", "").replace("\r\n", "\n").replace("\r", "\n")
    code = lambda s: hold("\n" + "\n".join("    " + x for x in s.strip("\n").split("\n")) + "\n")
    if "markdown" in families:
        t = re.sub(r"^```[^\n]*\n([\s\S]*?)(?:^```[ \t]*$|\Z)", lambda m: code(m[1]), t, flags=re.M)
        t = re.sub(r"(?<!`)`([^`\n]+)`", lambda m: hold(m[1]), t)
    if "latex" in families:
        t = re.sub(r"\\begin\{verbatim\}([\s\S]*?)(?:\\end\{verbatim\}|\Z)", lambda m: code(m[1]), t)
        t = re.sub(r"\$\$([^$]+)\$\$|\\\[([\s\S]+?)\\\]", lambda m: hold("\n$" + (m[1] or m[2]).strip() + "$\n"), t)
        t = re.sub(r"\\\(([\s\S]+?)\\\)|(?<![\\$])\$([^$\n]+)\$", lambda m: hold("$" + (m[1] or m[2]).strip() + "$"), t)
    if "html" in families:
        t = re.sub(r"<math\b[^>]*>([\s\S]*?)(?:</math>|\Z)", lambda m: hold("$" + re.sub(r"<[^>]+>", " ", m[1]).strip() + "$") if _MATH_LATEX.search(m[1]) else m[0], t, flags=re.I)
        for _ in range(2):  # escaped markup is markup once more
            if not re.search(_TAG + r"|<!--|&[#\w]", t, re.I):
                break
            r = _Renderer()
            r.feed(t)
            r.close()
            new = "".join(r.out).replace("\x02", "$").replace("\x03", "$")
            if new == t:
                break
            t = new
        t = re.sub(r"&(lt|gt|amp|quot|nbsp)\b;?", lambda m: entities.unescape(f"&{m[1]};"), t)
    if "wiki" in families:
        t = re.sub(r"\[\[(?:File|Image):[^\[\]|]*(?:\|[^\[\]|]*)*?\|?([^\[\]|]*)\]\]", r"\1\n", t)
        t = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", t)
        t = re.sub(r"\[(?:https?|ftp)://\S+?(?: ([^\]\n]*))?\]", lambda m: m[1] or "", t)
        t = re.sub(r"\{\{[^{}|\n]*\|?([^{}\n]*)\}\}", lambda m: ", ".join(x.split("=", 1)[-1] for x in m[1].split("|") if x), t)
        t = re.sub(r"^\{\|.*$|^\|\}.*$|^\|-.*$", "", t, flags=re.M)
        t = re.sub(r"^[!|](?!\|)[ \t]*(.*)$", lambda m: re.sub(r"[ \t]*(?:!!|\|\|)[ \t]*", " | ", m[1]), t, flags=re.M) if "||" in text or "!!" in text or "{|" in text else t
        t = re.sub(r"'{2,5}", "", t)
        t = re.sub(r"^([*#:;]+)[ \t]*", lambda m: m[0] if m[1][0] == "#" and "markdown" in families else "  " * (len(m[1]) - 1) + ("- " if m[1][-1] in "*#" else ""), t, flags=re.M)
        t = re.sub(r"^(={1,6})[ \t]*(.+?)[ \t]*\1[ \t]*$", lambda m: "#" * len(m[1]) + " " + m[2], t, flags=re.M)
    if "latex" in families:
        t = re.sub(r"\\((?:sub)*)section\*?\{([^{}]*)\}", lambda m: "\n" + "#" * (2 + len(m[1]) // 3) + f" {m[2]}\n", t)
        t = re.sub(r"\\begin\{tabular\}(?:\{[^{}]*\})?([\s\S]*?)(?:\\end\{tabular\}|\Z)", lambda m: re.sub(r"[ \t]*(?<!\\)&[ \t]*", " | ", re.sub(r"\\\\|\\hline", "", m[1])), t)
        t = re.sub(r"\\(?:begin|end)\{[a-zA-Z*]+\}(?:\[[^\]\n]*\]|\{[^{}\n]*\})*", "\n", t)
        t = re.sub(r"^[ \t]*\\item\b[ \t]*", "- ", t, flags=re.M)
        marks = {'"': "\u0308", "'": "\u0301", "`": "\u0300", "^": "\u0302", "~": "\u0303", "c": "\u0327", "v": "\u030c", "=": "\u0304", ".": "\u0307"}
        t = re.sub(r"\\([\"'`^~=.cv])(?:\{\\?([A-Za-z])\}|(?<![cv])([A-Za-z]))", lambda m: unicodedata.normalize("NFC", (m[2] or m[3]) + marks[m[1]]), t)
        for _ in range(4):
            new = re.sub(r"\\(?:ref|cite|label|pageref|eqref)\{([^{}]*)\}", r"[\1]", t)
            new = re.sub(r"\\[a-zA-Z]+\*?(?:\[[^\]\n]*\])?\{([^{}]*)\}", r"\1", new)
            new = re.sub(r"\{\\[a-zA-Z]+[ \t]+([^{}]*)\}", r"\1", new)
            if new == t:
                break
            t = new
        t = re.sub(r"\\l?dots\b", "…", t)
        t = re.sub(r"\\([%&#_${}])", r"\1", re.sub(r"\\[,;: ]", " ", t))
        t = re.sub(r"~", " ", t)
        t = re.sub(r"\\\\", "\n", t)
        t = re.sub(r"\\[a-zA-Z]+\b[ \t]*", "", t)
    if "markdown" in families:
        t = re.sub(r"^(.+)\n(=|-)\2{2,}[ \t]*$", lambda m: ("# " if m[2] == "=" else "## ") + m[1], t, flags=re.M)
        t = re.sub(r"!?\[([^\]\n]*)\]\([^)\n]*\)", r"\1", t)
        t = re.sub(r"^\[\^([\w-]+)\]:[ \t]*", r"\1: ", t, flags=re.M)
        t = re.sub(r"\[\^[\w-]+\]", "", t)
        t = re.sub(r"^[ \t]*[-*+][ \t]+\[([ xX])\][ \t]+", "- ", t, flags=re.M)
        t = re.sub(r"^([ \t]*)[*+][ \t]+", r"\1- ", t, flags=re.M)
        t = re.sub(r"(\*\*|__|~~)(?=\S)(.+?)(?<=\S)\1", r"\2", t)
        t = re.sub(r"(?<![\w*_])([*_])(?=[^\s*_])([^*_\n]+?)(?<=\S)\1(?![\w*_])", r"\2", t)
        t = re.sub(r"^>[ \t]?", "", t, flags=re.M)
        t = re.sub(r"^\|?[ \t]*:?-{2,}.*$\n?", "", t, flags=re.M)
        t = re.sub(r"^\|[ \t]*(.*?)[ \t]*\|[ \t]*$", r"\1", t, flags=re.M)
    while "\x00" in t:
        t = re.sub("\x00(\\d+)\x01", lambda m: held[int(m[1])], t)
    t = re.sub(r"[ \t]+$", "", t, flags=re.M)
    return re.sub(r"\n{3,}", "\n\n", t).strip("\n ") if "    " not in t else re.sub(r"\n{3,}", "\n\n", t).strip("\n")


# the operator


def labelled_blocks(
    df: DataFrame, key: str = "result_id", predictions: str = "predictions", documents: int = TRAINING_DOCUMENTS, clean: bool = True
) -> DataFrame:
    """A row for each block: ``key``, prediction_no, block_no (from 1), families, and clean_text if ``clean``.

    All blocks of a row are one sequence for the network, so nothing is shuffled. Null entries of ``predictions`` and
    ``blocks`` give no row but count as positions; null and empty html gives no families, null html a null text. Null
    predictions give no rows. Repeated rows are read each; other columns aren't. No rows, no rows.
    """
    net = trained(documents)  # of fixed size; goes to the tasks with the function
    kind = df.schema[key].dataType.simpleString()
    html = F.transform(F.col(f"`{predictions}`"), lambda p: F.transform(p["blocks"], lambda b: F.when(b.isNotNull(), F.struct(b["html"].alias("html")))))
    rows = df.select(F.col(f"`{key}`").alias("key"), html.alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                out: dict[str, list] = {"key": [], "prediction_no": [], "block_no": [], "families": [], "clean_text": []}
                rows = [
                    [(p, n, x["html"]) for p, blocks in enumerate(predictions or [], 1) for n, x in enumerate(blocks or [], 1) if x is not None]
                    for predictions in part.column(1).to_pylist()
                ]
                filled = [[h for _, _, h in places if h] for places in rows]
                labels = iter(label_documents(net, [f for f in filled if f]))
                for k, places, some in zip(part.column(0), rows, filled):
                    found = iter(next(labels) if some else [])
                    for p, n, h in places:
                        families = next(found) if h else []
                        for name, v in zip(out, (k.as_py(), p, n, families, clean_text(h, families) if clean else None)):
                            out[name].append(v)
                if out["key"]:
                    types = [part.schema.field(0).type, pa.int32(), pa.int32(), pa.list_(pa.string()), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    return rows.mapInArrow(run, f"key {kind}, prediction_no int, block_no int, families array<string>, clean_text string").withColumnRenamed("key", key)
