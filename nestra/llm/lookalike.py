"""Visually identical text with different characters: one consistent form.

Characters that do not show are dropped, blanks become spaces, width and compatibility forms become the plain letter or sign (raised, lowered, circled, squared and fraction forms stay), accents are decomposed. Letters of different
scripts that have the same shape form a class with a spelling per script. Scripts come from the script extensions of Unicode; letters of Chinese, Japanese and Korean writing also count as what they are written together in, and common
or inherited characters fit every script. For each token the sets of scripts that can spell its letters are intersected: if one script spells all, the token is written in it (mixed-script
confusables vanish); if several can (a whole-script confusable) it is written in Latin, short words in the script that dominates the text; if none can, each letter takes its class's first spelling. All of this depends only on shapes,
so texts that look the same come out equal, and only those.
"""

from __future__ import annotations

import unicodedata
from hashlib import blake2b

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestra.runtime import Workspace

# Letters of the same shape, after the single-letter cases of the Unicode table of confusables (UTS 39) that have one glyph in common typefaces. Each pair of rows has a Latin letter above the letter of the other script.
# Letters of one script never form a class, however alike (a and alpha-shaped a, g with one or two storeys): within a script they are other letters.
SAME_SHAPE = {
    "Cyrl": ("aeopcyxsijhdqwlvABEKMHOPCTYXSIJQWVIG", "аеорсухѕіјһԁԛԝӏѵАВЕКМНОРСТУХЅІЈԚԜѴӀԌ"),
    "Grek": ("ovpjcABEZHIKMNOPTYXCJF", "ονρϳϲΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿϜ"),
    "Armn": ("onuhgqjOU", "օոսհցզյՕՍ"),
    "Cher": ("ADEGHJKLMPRSTWZCVB", "ᎪᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᎳᏃᏟᏙᏴ"),
    "Lisu": ("BPDTGKJCZFMNLSRVHWXYAEIOU", "ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ"),
    "Copt": ("BHIKMNOPCTYXopc", "ⲂⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥ"),
}
# Letters of the same shape in Greek (above) and Cyrillic (below) without a Latin counterpart.
GREEK_CYRILLIC = ("ΓΠΦ", "ГПФ")
# Kinds of decomposition after which a letter or sign is still the same.
SAME_FORM = ("<wide>", "<narrow>", "<font>", "<compat>", "<noBreak>", "<small>", "<initial>", "<medial>", "<final>", "<isolated>", "<vertical>")
# Compatibility forms that do look different: the long s and its ligature.
NOT_SAME = "ſﬅẛ"
# Characters beyond the format category that do not show.
UNSEEN = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
LINE_ENDS = "\x85\u2028\u2029"
HYPHENS = "\u2010\u2011"

# Codes of scripts (ISO 15924), those with letters of shared shapes first, in the order of preference; and what scripts are written together in.
SCRIPTS = ("Latn", "Grek", "Cyrl", "Armn", "Cher", "Lisu", "Copt")
MORE_SCRIPTS = "Hebr Arab Syrc Thaa Nkoo Deva Beng Guru Gujr Orya Taml Telu Knda Mlym Sinh Thai Laoo Tibt Mymr Geor Hang Ethi Cans Ogam Runr Khmr Mong Hira Kana Bopo Hani Yiii Goth Glag Tfng Vaii Bamu Java Bali Dsrt Osge Adlm".split()
TOGETHER = {"Hani": ("Jpan", "Kore", "Hanb"), "Hira": ("Jpan",), "Kana": ("Jpan",), "Hang": ("Kore",), "Bopo": ("Hanb",)}
_PATTERNS = {code: regex.compile(rf"\p{{scx={code}}}") for code in (*SCRIPTS, *MORE_SCRIPTS)}
_ANY = regex.compile(r"[\p{Script=Common}\p{Script=Inherited}]")


def _classes() -> tuple[dict[str, str], dict[str, dict[str, str]]]:
    """Letter -> its class's first spelling; first spelling -> spelling by script."""
    first: dict[str, str] = {}
    spelled: dict[str, dict[str, str]] = {}
    for script, (latin, other) in SAME_SHAPE.items():
        for a, b in zip(latin, other, strict=True):
            first[b] = a
            spelled.setdefault(a, {"Latn": a}).setdefault(script, b)
    for a, b in zip(*GREEK_CYRILLIC, strict=True):
        first[b] = a
        spelled[a] = {"Grek": a, "Cyrl": b}
    return first, spelled


FIRST, SPELLED = _classes()


class _Shapes(dict):
    """Code point -> what it looks like: first spellings and separate accents. Filled on demand."""

    def __missing__(self, code: int) -> str:
        self[code] = out = self._shape(chr(code))
        return out

    def _shape(self, c: str) -> str:
        if c in FIRST:
            return FIRST[c]
        if c == "\n":
            return c
        if c in LINE_ENDS:
            return "\n"
        if c in HYPHENS:
            return "-"
        kind = unicodedata.category(c)
        if kind == "Zs" or c in "\t\v\f":
            return " "
        if kind in ("Cf", "Cc") or ord(c) in UNSEEN:
            return ""
        parts = unicodedata.decomposition(c).split()
        if not parts or c in NOT_SAME:
            return c
        if parts[0].startswith("<"):
            if parts[0] not in SAME_FORM or parts[1] == "0020":
                return c
            parts = parts[1:]
        return "".join(self[int(p, 16)] for p in parts)


_SHAPES = _Shapes()
_TOKEN = regex.compile(r"[\p{L}\p{M}]*[^\x00-\x7f\P{L}][\p{L}\p{M}]*")  # tokens with a letter beyond ASCII
_SHORT = regex.compile(r"(?<![\p{L}\p{M}])\p{L}\p{M}*(?:\p{L}\p{M}*)?(?![\p{L}\p{M}])")  # tokens of one or two letters


def shape(text: str) -> str:
    """What a text looks like, in first spellings: equal for two texts exactly if they look the same."""
    if text.isascii():
        if text.isprintable():
            return text
        return text.replace("\r\n", "\n").replace("\r", "\n").translate(_SHAPES)
    return unicodedata.normalize("NFD", text.replace("\r\n", "\n").replace("\r", "\n").translate(_SHAPES))


class _Extended(dict):
    """Character -> the scripts that it is written in, with joint ones; None if it fits every script. Filled on demand."""

    def __missing__(self, c: str) -> frozenset[str] | None:
        own = [code for code, pattern in _PATTERNS.items() if pattern.match(c)]
        if not own and _ANY.match(c):
            self[c] = None
        else:
            own = own or [unicodedata.name(c, "?").split(" ")[0]]  # a script beyond the list goes by the name of its characters
            self[c] = frozenset(own) | {joint for code in own for joint in TOGETHER.get(code, ())}
        return self[c]


_EXTENDED = _Extended()


def _meet(sets) -> frozenset[str]:
    sets = [s for s in sets if s is not None]
    return frozenset.intersection(*sets) if sets else frozenset()


def scripts_of(letter: str) -> frozenset[str] | None:
    """The scripts that have a letter of this shape; None if it fits every script."""
    return frozenset(SPELLED[letter]) if letter in SPELLED else _EXTENDED[letter]


def resolve(token: str) -> frozenset[str]:
    """The scripts in which a whole token (as a shape) can be spelled; empty if there is none."""
    return _meet(scripts_of(c) for c in token if c.isalpha())


def respell(token: str, script: str) -> str:
    return "".join(SPELLED[c].get(script, c) if c in SPELLED else c for c in token)


_SPELLING: dict[str, tuple[str, str]] = {}


def _spelling(token: str) -> tuple[str, str]:
    """(consistent spelling, its script where only one can spell the token and it is not Latin)."""
    if (known := _SPELLING.get(token)) is None:
        if len(_SPELLING) > 1 << 18:
            _SPELLING.clear()
        can = resolve(token)
        if not can or "Latn" in can:
            known = (token, "")
        else:
            best = min(can, key=lambda s: (SCRIPTS.index(s) if s in SCRIPTS else len(SCRIPTS), s))
            known = (respell(token, best), best if len(can) == 1 else "")
        _SPELLING[token] = known
    return known


def consistent(text: str) -> str:
    """The one form of all texts that look like ``text``."""
    seen = shape(text)
    if seen.isascii():
        return seen
    weight: dict[str, int] = {}

    def spell(m) -> str:
        out, only = _spelling(m[0])
        if only:
            weight[only] = weight.get(only, 0) + len(out)
        return out

    out = _TOKEN.sub(spell, seen)
    if weight:
        script = max(weight, key=lambda s: (weight[s], s))
        if script in SCRIPTS and weight[script] * 3 > len(seen):  # it dominates the text: its short words are its own
            out = _SHORT.sub(lambda m: respell(m[0], script) if script in resolve(m[0]) else m[0], out)
    return unicodedata.normalize("NFC", out)


def mixed(text: str) -> int:
    """How many tokens of a text are written in more than one script."""
    decomposed = unicodedata.normalize("NFD", text)
    letters = ([_EXTENDED[c] for c in m[0] if c.isalpha()] for m in _TOKEN.finditer(decomposed))
    return sum(any(s is not None for s in sets) and not _meet(sets) for sets in letters)


def _normalize(batches):
    for b in batches:
        texts = b.column("text").to_pylist()
        out = [None if t is None else consistent(t) for t in texts]
        changed = [t is not None and t != o for t, o in zip(texts, out, strict=True)]
        n_mixed = [0 if t is None or t.isascii() else mixed(t) for t in texts]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string()), pa.array(changed, pa.bool_()), pa.array(n_mixed, pa.int32())], ["doc_id", "text", "changed", "n_mixed"])


def normalize(documents: DataFrame) -> DataFrame:
    """``doc_id, text, changed, n_mixed``: each text in its consistent form, whether that differs from the given text, and the number of tokens that mixed scripts.

    A null text stays null and unchanged; an empty one stays empty; a text of invisible characters becomes empty. One row per row of ``documents``, whole texts; an empty table gives no rows.
    """
    return documents.select("doc_id", "text").mapInArrow(_normalize, "doc_id bigint, text string, changed boolean, n_mixed int")


def unstable(documents: DataFrame) -> DataFrame:
    """``doc_id`` of the texts whose consistent form has another consistent form or another look than the text; there are none if forms are right."""

    def find(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            bad = [t is not None and ((form := consistent(t)) != consistent(form) or shape(form) != shape(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").filter(pa.array(bad, pa.bool_()))], ["doc_id"])

    return documents.select("doc_id", "text").mapInArrow(find, "doc_id bigint")


def _sign(batches):
    for b in batches:
        ids, cols = [], [[], [], [], []]
        for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            if t and i is not None:
                ids.append(i)
                for k, form in enumerate((consistent(t), t)):
                    h = blake2b(form.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    cols[2 * k].append(int.from_bytes(h[:8], "big", signed=True))
                    cols[2 * k + 1].append(int.from_bytes(h[8:], "big", signed=True))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in cols)], ["doc_id", "look1", "look2", "text1", "text2"])


LOOK, TEXT = ["look1", "look2"], ["text1", "text2"]
_SIGNS = "doc_id bigint, look1 bigint, look2 bigint, text1 bigint, text2 bigint"


def _classes_of(documents: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """(distinct texts of the classes with several, with the number and the least id of their documents; the documents' digests)."""
    signs = ws.write(documents.select("doc_id", "text").mapInArrow(_sign, _SIGNS))
    texts = ws.write(signs.groupBy(*LOOK, *TEXT).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")))
    several = texts.groupBy(*LOOK).agg(F.count(F.lit(1)).alias("n_texts")).where("n_texts > 1")
    return ws.write(texts.join(several, LOOK)), signs


def lookalike_classes(documents: DataFrame) -> DataFrame:
    """``class_id, doc_id, text_id, n_texts, n_docs``: one row per document of each class of texts that look the same but are not all the same code points.

    class_id is the least doc_id of the class and text_id that of the documents with the same code points; n_texts and n_docs are the different texts and the documents of the class. Null and empty texts and null doc_ids are in no
    class; repeated rows stay; an empty table gives no rows.
    """
    ws = Workspace(documents.sparkSession)
    texts, signs = _classes_of(documents, ws)
    classes = texts.groupBy(*LOOK).agg(F.min("least").alias("class_id"), F.sum("n").alias("n_docs"))
    named = ws.write(texts.join(classes, LOOK).select(*TEXT, "class_id", F.col("least").alias("text_id"), "n_texts", "n_docs"))
    return signs.join(named, TEXT).select("class_id", "doc_id", "text_id", "n_texts", "n_docs")


def lookalike_pairs(documents: DataFrame, block: int = 1000) -> DataFrame:
    """``doc_id_a, doc_id_b``: all pairs of documents (smaller id first) whose texts look the same but are not the same code points.

    Null and empty texts and null doc_ids are in no pair; copies of one text pair with every lookalike of it but not with each other; repeated rows pair as often as they occur. Texts are compared whole, by 128-bit digests of the
    consistent form and of the text. Different texts pair first; their documents come in through blocks of about ``block``, so a text that is posted very often is no hot key: every join is by text and block. A class of very many different texts is divided by salts.
    """
    ws = Workspace(documents.sparkSession)
    texts, signs = _classes_of(documents, ws)
    sized = texts.select(*LOOK, *TEXT, F.ceil(F.col("n") / block).cast("int").alias("blocks"), F.ceil(F.col("n_texts") / block).cast("int").alias("salts"))
    side = lambda x, salt: sized.select(*LOOK, *[F.col(c).alias(f"{c}{x}") for c in (*TEXT, "blocks")], salt.alias("salt"))
    left, right = side("a", F.pmod(F.xxhash64(*TEXT), "salts").cast("int")), side("b", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    pairs = left.join(right, [*LOOK, "salt"]).where("text1a < text1b or (text1a = text1b and text2a < text2b)").drop("salt")
    for x in "ab":
        pairs = pairs.withColumn(f"block{x}", F.explode(F.sequence(F.lit(0), F.col(f"blocks{x}") - 1)))
    members = signs.join(sized.select(*TEXT, "blocks"), TEXT).select(*TEXT, "doc_id", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int").alias("block"))
    members = ws.write(members)
    for x in "ab":
        pairs = pairs.join(members.select(F.col("doc_id").alias(f"doc{x}"), *[F.col(c).alias(f"{c}{x}") for c in (*TEXT, "block")]), [f"{c}{x}" for c in (*TEXT, "block")])
    return pairs.select(F.least("doca", "docb").alias("doc_id_a"), F.greatest("doca", "docb").alias("doc_id_b"))
