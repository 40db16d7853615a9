"""Personal information in free text, found by anchors and replaced by typed placeholders.

One Aho-Corasick automaton finds anchors: at-signs however written, address
schemes, cues of identifiers, phone numbers, accounts, addresses and names, forms
of address, kinds of streets, digits and digit words, capital letters after a
blank. From each anchor a local parser expands to the boundaries of the value,
however far they are, and validates it. A parser doesn't read a stretch twice
that it has read from an earlier anchor, so texts are read in linear time.

Names have no shape of their own. They are read after cues and forms of address,
and anywhere as two or three capitalised words of which none is a word of the
language. What the words of a language are, and which of them are written in
capitals only, is read off the public vocabularies (``_lexicon``), not off lists of
names: a word whose lower-case form is a token of its own is an ordinary word.

Texts are read in a normalised form (dashes, spaces and invisible characters of
all kinds made plain) whose characters point back to the original, so a
placeholder replaces exactly what was written and the rest stays as it was.

Kinds: email, phone, national_id, street_address, person_name. Account numbers
(IBAN, card numbers) are recognised so that no part of them is taken for another
kind; they are none of the kinds and stay. Cases: null and empty parts hold
nothing; a message delivered twice counts once; object parts are read by their
text field. Where two values overlap the earlier kind in PRIORITY wins, so a name
inside an email address is no name of its own.
"""

from __future__ import annotations

import base64
import json
import os
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.functions.text import part_text

KINDS = ("email", "phone", "national_id", "street_address", "person_name")
PRIORITY = {k: i for i, k in enumerate(("email", "account", "national_id", "phone", "street_address", "person_name"))}

_DASHES = dict.fromkeys(map(ord, "‐‑‒–−﹣－"), "-")
_SPACES = dict.fromkeys(map(ord, "               　\t"), " ")
_FULL = {0xFF10 + i: str(i) for i in range(10)} | {0xFF20: "@", 0xFF0E: ".", 0x2019: "'", 0x02BC: "'"}
_PLAIN = _DASHES | _SPACES | _FULL
_INVISIBLE = re.compile("[­​‌‍⁠﻿]")


def normalised(text: str) -> tuple[str, list[int] | None]:
    """The text in plain characters, and for each its place in the original (None: the same)."""
    if text.isascii():
        return text.replace("\t", " "), None
    plain = text.translate(_PLAIN)
    if not _INVISIBLE.search(plain):
        return plain, None
    kept = [i for i, c in enumerate(plain) if not _INVISIBLE.match(c)]
    return "".join(plain[i] for i in kept), kept


def lowered(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


# -- anchors ---------------------------------------------------------------------

AT = ("@", "(at)", "[at]", "{at}", "<at>", " at ")
ID_CUES = (
    "social security", "ssn", "my social", "social, ", "social is", "social:", "nino", "ni no", "national insurance", "insurance no", "insurance number", "steuer", "sozialversicherung", "mon nir", "nir ", "numéro de sécu", "sécurité sociale", "dni", "nie ", "nif",
    "passport", "passeport", "reisepass", "pasaporte", "licence", "license", "permis de conduire", "führerschein", "tax id", "taxpayer", "tax number", "itin", "ausweis", "carnet de conducir", "identity card", "id card", "identity number", "cédula",
)
PHONE_CUES = ("number is", "phone", "tel", "call", "mobile", "whatsapp", "erreichbar", "text ", "cell", "handy", "fax", "sms", "teléfono", "móvil", "téléphone", "portable", "ring me", "reach me on", "dial")
ADDRESS_CUES = ("home is", "moved to", "move to", "rent at", "flat is at", "house is at", "habite", "adresse", "address", "ship to", "ship it", "deliver", "delivery", "send it to", "post it to", "mail it to", "live at", "lives at", "living at", "live on", "wohne", "wohnt", "vivo en", "vive en", "dirección", "domicil")
#: What comes before a name. After the first kind a name may be written in any case, if what follows shows where it ends.
NAME_CUES = (
    "signed by ", "lunch with ", "dinner with ", "coffee with ", "talk to ", "talked to ", "spoke to ", "spoke with ", "according to ", "owe ", "vi a ", "gestern ", "met ", "ask ", "asked ", "told ", "herself as ", "himself as ", "themselves as ", "that was ", "c'est ",
    "hi ", "hello ", "hey ", "dear ", "hallo ", "liebe ", "lieber ", "bonjour ", "hola ", "written for ", "written by ", "thanks, ", "thank you, ", "regards, ", "cheers, ", "best, ", "yours, ", "— ", "\n- ", "my name is ", "i am called ", "ich heiße ", "je m'appelle ", "me llamo ", "contact ", "named ", "called ",
)
WEAK_NAME_CUES = ("from ", "with ", "by ", "to ", "and ")
ACCOUNT_CUES = ("iban", "account", "konto", "cuenta", "compte", "card number", "card no", "karte", "tarjeta", "carte")
TITLES = ("dr", "mr", "mrs", "ms", "miss", "mme", "mlle", "herr", "herrn", "frau", "prof", "professor", "señor", "señora", "sra", "sr", "monsieur", "madame", "sir", "doctor")


@cache
def automaton():
    import ahocorasick

    found: dict[str, list] = {}
    for word in AT:
        found.setdefault(word, []).append("at")
    for kind, cues in (("id", ID_CUES), ("phone", PHONE_CUES), ("address", ADDRESS_CUES), ("name", NAME_CUES), ("weak", WEAK_NAME_CUES), ("account", ACCOUNT_CUES), ("digit", tuple("0123456789")), ("spelt", _DIGIT_WORDS.split("|")), ("german", _GERMAN_SUFFIXES.split("|")), ("spanish", _SPANISH_ANCHORS)):
        for cue in cues:
            found.setdefault(cue.replace("\\", ""), []).append(kind)
    for t in TITLES:
        for form in (t + " ", t + ". "):
            found.setdefault(form, []).append("title")
    a = ahocorasick.Automaton()
    for word, kinds in found.items():
        a.add_word(word, (word, tuple(kinds)))
    a.make_automaton()
    return a


# -- email ---------------------------------------------------------------------------

_LOCAL = re.compile(r"[\w.+%'-]*[\w+]\Z")
_DOT = r"(?:\.|\s?[\[({<]\s?dot\s?[\])}>]\s?|\s+dot\s+)"
_DOMAIN = re.compile(rf"[a-z0-9](?:[a-z0-9-]*[a-z0-9])?(?:{_DOT}[a-z0-9](?:[a-z0-9-]*[a-z0-9])?)*", re.I)
_LABELS = re.compile(_DOT, re.I)
_WORDS_BEFORE_AT = frozenset("so look looks looked looking here there meet met us me it is was arrive arrived live lives work works working sell sold seen found be been stay stayed aimed good bad up out down even not only just sales hosted available them him her you i we they page site website details more info".split())


def _email(text: str, start: int, word: str, out: list) -> None:
    spelt = word == " at "
    edge = start - (not spelt and start > 0 and text[start - 1] == " ")
    spaced = edge < start
    begin = edge
    while begin and (text[begin - 1].isalnum() or text[begin - 1] in "_.+%'-"):
        begin -= 1
    local = _LOCAL.search(text, begin, edge)
    if not local:
        return
    after = start + len(word)
    if text[after:after + 1] == " ":
        after += 1
        spaced = True
    domain = _DOMAIN.match(text, after)
    if not domain:
        return
    labels = _LABELS.split(domain.group())
    end = domain.end()
    if len(labels) < 2 or not labels[-1].isalpha() or len(labels[-1]) < 2:
        return
    name = local.group().lstrip(".-'")
    if spelt and (" dot " not in domain.group().lower() and "dot" not in domain.group().lower() or name.lower() in _WORDS_BEFORE_AT or (name.isalpha() and len(name) < 4)):
        return
    if word == "@" and spaced and "." not in domain.group() and "dot" not in domain.group().lower():
        return
    begin = edge - len(name)
    if text[max(0, begin - 7):begin].lower() == "mailto:":
        begin -= 7
    out.append((begin, end, "email"))


# -- identifiers ------------------------------------------------------------------------

#: What may stand between a cue and its number: no digit, no end of a sentence but the point of "no."
_ID_GAP = re.compile(r"(?:[^\d\n?!.#+]|(?<=\bno)\.|(?<=\bnr)\.|(?<=\bnum)\.)*", re.I)
_ID_VALUE = re.compile(r"[A-Za-z]{0,3}[ -]?\d(?:[\dA-Z]|[ \-./](?=\d)|[ -](?=[A-Z]\b(?!\w)))*", re.I)
_ANOTHER_CUE = re.compile(r"\b(?:phone|tel|call|mobile|whatsapp|erreichbar|text|cell|fax|isbn|order|ticket|row|build)\b", re.I)
_ID_SHAPES = re.compile(
    r"(?<![\w.#/-])(?:\d{3}-\d{2}-\d{4}"  # social security and taxpayer numbers
    r"|[A-CEGHJ-PR-TW-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]"  # national insurance number
    r"|\d{8}-[A-Z]|[XYZ]-?\d{7}-?[A-Z]"  # national document with check letter
    r"|[12] \d{2} \d{2} \d{2} \d{3} \d{3}(?: \d{2})?"  # social security number with birth date
    r"|[A-Z]\d{3}-\d{4}-\d{4})(?![\w-]|\.\d)", re.I)
#: A number that stands here for itself after whatever cue.
_DIGIT_WORDS = "zero|oh|one|two|three|four|five|six|seven|eight|nine|null|eins|zwei|drei|vier|fünf|sechs|sieben|acht|neun|cero|uno|dos|tres|cuatro|cinco|seis|siete|ocho|nueve|zéro|un|deux|trois|quatre|cinq|sept|huit|neuf"
_SPELT = re.compile(rf"\b(?:{_DIGIT_WORDS})(?:[ ,-]+(?:double |triple )?(?:{_DIGIT_WORDS})\b){{6,18}}", re.I)
_NOT_BEFORE = re.compile(r"(?:#|isbn|order|ticket|row|build|version|invoice|ref|item|serial|sku|tracking)[\s:.#a-z]{0,6}\Z")


def _digits(s: str) -> int:
    return sum(c.isdigit() for c in s)


def _is_cue(low: str, start: int, end: int) -> bool:
    """A short cue counts as a word of its own only."""
    word = low[start:end]
    return word not in ("dni", "nie ", "nif", "nir ", "ssn", "nino", "ni no", "itin") or not (start and low[start - 1].isalnum()) and not (word[-1] != " " and low[end:end + 1].isalpha())


def _identifier(text: str, low: str, cue_start: int, cue_end: int, next_cue: int, out: list) -> None:
    """The number after a cue, in its sentence and before the next such cue."""
    first = _ID_GAP.match(text, cue_end, next_cue).end()
    gap = text[cue_end:first]
    if first >= len(text) or not text[first].isdigit():
        spelt = _SPELT.search(text, cue_end, min(first, next_cue))
        if spelt:
            out.append((spelt.start(), spelt.end(), "national_id"))
        return
    if _ANOTHER_CUE.search(gap):
        return
    letters = re.search(r"(?<![A-Za-z])[A-Za-z]{1,3}[ -]?\Z", gap)
    begin = first - len(letters.group()) if letters and (letters.group().strip(" -").isupper() or len(letters.group()) <= 2 and letters.group()[-1:] not in " -") else first
    value = _ID_VALUE.match(text, begin)
    if not value:
        return
    got = value.group()
    while len(got) > 6 and re.search(r"[ -][A-Za-z]\Z", got) and _digits(got) not in (6, 8):
        got = got[:-2]
    if 6 <= _digits(got) <= 18:
        out.append((begin, begin + len(got), "national_id"))


# -- accounts: none of the kinds, but no other kind either ------------------------------

_IBAN = re.compile(r"(?<![\w-])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_CARD = re.compile(r"(?<![\w.#/-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?![\w-])")
_ACCOUNT_AFTER = re.compile(r"(?:\s+(?:number|no\.?|nr\.?|nummer|número|numéro))?\s*(?:is|ist|es|est|:|#)?\s*((?:\d[ -]?){7,}\d)(?!\w)")


def _valid_iban(value: str) -> bool:
    """The published check: country and check digits moved to the end, letters as numbers, remainder 1."""
    plain = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


# -- phone numbers -----------------------------------------------------------------------

_INTERNATIONAL = re.compile(r"(?<![\w.#/+-])(?:\+|00)[1-9]\d{0,2}[ .-]?(?:\(0\)[ .-]?)?\(?\d(?:[ .()-]{0,2}\d){6,12}(?![\w])")
_NATIONAL = re.compile(r"(?<![\w.#/-])(?:(?:1[-. ])?(?:\(\d{3}\) ?|\d{3}[-. ])\d{3}[-. ]\d{4}|\(0\d{2,4}\)[ /-]?\d{3,4}[ -]?\d{3,4}|0\d{2,4}[ /-]\d{3,4}[ -]?\d{3,4}|0\d(?:[ .]\d\d){4})(?:,? ?(?:ext\.?|x|extension) ?\d{1,5})?(?![\w-]|\.\d)", re.I)
_AFTER_CUE = re.compile(r"[^\d\n+(]{0,14}(\(?\+?\(?\d(?:[ .()/-]{0,2}\d){6,14})(?![\w])")


def _phone_after(text: str, cue_end: int, out: list) -> None:
    m = _AFTER_CUE.match(text, cue_end)
    if m and 7 <= _digits(m.group(1)) <= 15 and not re.match(r"\d{4}-\d\d-\d\d", m.group(1)) and not _NOT_BEFORE.search(text[cue_end:m.start(1)].lower()):
        a = m.start(1)
        out.append((a + 1 if text[a] == "(" and ")" not in m.group(1) else a, m.end(1), "phone"))


# -- street addresses ----------------------------------------------------------------------

_TYPES = "street|st|avenue|ave|road|rd|lane|ln|drive|dr|court|ct|close|terrace|ter|way|place|pl|square|sq|crescent|cres|boulevard|blvd|grove|gardens|mews|parkway|pkwy|highway|hwy|walk|quay|hill|row"
_UNIT = r"(?:(?:flat|apt\.?|apartment|unit|suite|no\.?)\s*[\w-]{1,5},?\s+)?"
_TAIL = r"(?:,?\s+\d{4,6}\s+[A-ZÀ-Þ][\w-]+|,[ ]*[A-ZÀ-Þ][\w-]+(?: \d{4,6})?)?"
_ENGLISH = re.compile(rf"(?<![\w#.:-])(?i:{_UNIT})\d{{1,5}}[a-zA-Z]?,? (?:[A-ZÀ-Þ][\w'-]+ ){{1,3}}?(?i:{_TYPES})\b\.?(?![-'\w]){_TAIL}")
_ENGLISH_ANY = re.compile(rf"[\s:,(\n]*{_UNIT}\d{{1,5}}[a-z]?,? (?:[^\W\d][\w'-]+ ){{1,3}}?(?:{_TYPES})\b\.?(?![-'\w])(?:,? [\w-]+ \d{{4,6}}|, ?(?-i:[A-ZÀ-Þ])[\w-]+)?", re.I)
_GERMAN_SUFFIXES = r"straße|strasse|str\.|str|weg|gasse|allee|platz|pfad|ufer|damm|steig|chaussee"
_GERMAN = re.compile(r"(?<![\w-])[^\W\d_][\w-]{2,}(?:straße|strasse|str\.|str|weg|gasse|allee|platz|pfad|ufer|damm|steig|chaussee)\s+\d{1,4}(?:\s?[a-z])?(?![\w.:%])(?:,?\s+\d{5}\s+[\w-]+)?", re.I)
_FRENCH = re.compile(r"(?<![\w#.-])\d{1,4}(?:\s?(?:bis|ter|quater))?,? (?:rue|avenue|boulevard|bd|place|impasse|chemin|allée|allee|quai|cours|square|route|passage|ruelle) (?:(?:de|du|des|la|le|les|d'|l'|de l'|de la) ?){0,2}[^\W\d_][\w'-]*(?:[ -][A-ZÀ-Þ][\w'-]*){0,3}", re.I)
_SPANISH_ANCHORS = ("calle", "c/", "avda", "av.", "avenida", "plaza", "paseo", "camino", "carrera", "ronda", "travesía")
_SPANISH_TYPES = r"(?:calle|c/|avda\.?|av\.|avenida|plaza|paseo|camino|carrera|ronda|travesía)"
_SPANISH_NUMBER = r",?\s+(?:n[º°.]\s*)?\d{1,4}(?![\w%:])(?:, ?\d{1,2}[ºª°](?: ?[A-Z]\b)?)?"
_SPANISH = re.compile(rf"(?<!\w)(?i:{_SPANISH_TYPES})\s+(?:[^\W\d_][\w'-]*\s+){{0,4}}?[A-ZÀ-Þ][\w'-]*{_SPANISH_NUMBER}")
_SPANISH_ANY = re.compile(rf"[\s:]*{_SPANISH_TYPES}\s+(?:[^\W\d_][\w'-]*\s+){{0,4}}?[^\W\d_][\w'-]*{_SPANISH_NUMBER}", re.I)
_PLAIN_WORDS = frozenset("the and of to a an in on at by is was were for with from percent days steps weeks hours minutes pages people questions points while that this their its it lane road or not more than other each every old new".split())


#: Without capitals the kind of street must be a whole word, and the name no ordinary one.
_ENGLISH_LOW = re.compile(rf"(?<![\w#.:-]){_UNIT}\d{{1,5}}[a-z]?,? (?P<name>(?:[^\W\d_][\w'-]+ ){{1,2}}?)(?:street|avenue|road|lane|drive|court|terrace|crescent|square|boulevard|grove|gardens|mews|parkway)\b(?![-'\w])(?:, ?[^\W\d_][\w-]+)?", re.I)
_UNIT_BEFORE = re.compile(r"(?:flat|apt\.?|apartment|unit|suite|no\.?) ?(?:[\w-]{1,5},? )?\Z", re.I)


def _english(text: str, start: int, out: list, floor: int) -> int:
    """A number, a name of one to three words and a kind of street; the unit before it belongs to it. Returns where the match ends."""
    unit = _UNIT_BEFORE.search(text, max(floor, start - 18), start)
    for at in ([unit.start(), start] if unit else [start]):
        m = _ENGLISH.match(text, at)
        if m:
            words = re.findall(r"(?<!\w)[^\W\d_][\w'-]*", m.group())
            if not any(w.lower() in _PLAIN_WORDS for w in words[:-1] if w.lower() not in ("lane", "road")):
                out.append((m.start(), m.end(), "street_address"))
            return m.end()
        m = _ENGLISH_LOW.match(text, at)
        if m and not any(_ordinary(w) or len(w) < 4 for w in m.group("name").split()):
            out.append((m.start(), m.end(), "street_address"))
            return m.end()
    return floor


def _address_after(text: str, low: str, end: int, out: list) -> None:
    """An address after a cue, in any case."""
    colon = re.compile(r"[^\d\n:]{0,12}:?\s*").match(low, end)
    for at in {end, colon.end() if colon else end}:
        m = _ENGLISH_ANY.match(text, at) or _SPANISH_ANY.match(text, at)
        if m:
            name = re.sub(r"^[\s:,(\n]*", "", m.group())
            out.append((m.end() - len(name), m.end(), "street_address"))
            break


# -- names ---------------------------------------------------------------------------------

_T = r"[A-ZÀ-ÖØ-Þ](?:[^\W\d_]|['])*[^\W\d_](?:-[A-ZÀ-ÖØ-Þ][^\W\d_]+)*"
_ANY = r"[^\W\d_](?:[^\W\d_]|['])*[^\W\d_](?:-[^\W\d_]+)*"
_TITLE = r"(?:(?:" + "|".join(TITLES) + r")\.?\s+)"
_CASED = re.compile(rf"(?:{_T}(?: [A-ZÀ-Þ]\.)? {_T}|[A-ZÀ-Þ]\. ?(?:[A-ZÀ-Þ]\. ?)?{_T}|{_T}, {_T}(?![\w]))")
_TITLED = re.compile(rf"(?i:{_TITLE})(?:[A-ZÀ-Þ]\. ?)?({_T}(?: (?:[A-ZÀ-Þ]\. )?{_T})?)")
_TITLED_ANY = re.compile(rf"{_TITLE}(?:{_ANY} )?(?:[^\W\d_]\. ?)?({_ANY})", re.I)
_LOOSE = re.compile(rf"(?:{_ANY}(?: [^\W\d_]\.)? {_ANY}|[^\W\d_]\. ?{_ANY}|{_ANY}, {_ANY})", re.I)
#: Words that begin no name: function words, calendar words and words of places, houses and undertakings.
NO_NAME = frozenset(
    "the a an this that these those my our your his her their its some any no every each one two another such what which who it he she they we you i there here so if when and or but not do does did is was are were be been "
    "monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december morning evening night today yesterday tomorrow next last "
    "street road avenue lane drive court close square hall hotel harbour harbor mill lantern choir project old new main north south east west river lake mount saint fort port cafe bar club team group bank university school college company management board committee office department church station park bridge house inn pub market museum theatre hospital library clinic "
    "der die das ein eine den dem mein meine dein unser le la les un une mon ma mes el los las mi su sus una uno ce cette je ich".split())


#: The folder of the public vocabularies; ``found`` and ``redacted`` take another one as a parameter.
TOKENIZERS = os.environ.get("THREADMILL_TOKENIZERS", "/opt/tokenizers")
_folder = TOKENIZERS


def lexicon() -> tuple[frozenset[str], frozenset[str]]:
    return _lexicon(_folder)


@cache
def _lexicon(folder: str) -> tuple[frozenset[str], frozenset[str]]:
    """(ordinary words, words that are names) by the public vocabularies of a folder, in lower case.

    A token with a blank before it is a word or the beginning of one, and tokens
    are ranked by how often their parts were met. A word that comes in lower case,
    and there earlier than with a capital, is an ordinary word of some language;
    one that comes with a capital only, or earlier, is a name.
    """
    with open(f"{folder}/byte_bpe_50k.json", encoding="utf-8") as fh:
        one = {t[1:]: i for t, i in json.load(fh)["model"]["vocab"].items() if t.startswith("\u0120")}
    many: dict[str, int] = {}
    with open(f"{folder}/byte_bpe_multi_50k.tiktoken", "rb") as fh:
        for line in fh:
            token, rank = line.split()
            token = base64.b64decode(token)
            if token.startswith(b" "):
                many[token[1:].decode("utf-8", "ignore")] = int(rank)
    ordinary, names = set(), set()
    never = 1 << 40
    for ranks in (one, many):
        for w in {t.lower() for t in ranks if t.isalpha() and len(t) > 1}:
            low, high = ranks.get(w, never), ranks.get(w.capitalize(), never)
            (ordinary if low < high else names).add(w)
    return frozenset(ordinary), frozenset(names - ordinary)


def _ordinary(word: str) -> bool:
    """Whether every part of a word, between hyphens, is an ordinary word."""
    return all(len(p) > 2 and p.lower() in lexicon()[0] for p in word.split("-"))


#: What ends a name that isn't written with capitals: a mark, the end of the line, or a word that goes on with the sentence.
_NAME_ENDS = re.compile(r"\s*(?:[,.;:!?)\n]|$)|'s\s|\s+(?:and|on|at|in|about|for|to|if|whether|again|who|that|a|an|the|en|el|la|y|qui|et|und|am|im|getroffen|gesehen)\b|\s+(?-i:[A-ZÀ-Þ“])", re.I)


def _is_name(value: str) -> bool:
    words = re.findall(r"[^\W\d_][\w']*", value)
    return bool(words) and not any(len(w) > 1 and w.lower() in NO_NAME for w in words)


def _name_after(text: str, low: str, start: int, end: int, weak: bool, out: list) -> None:
    """The name after a cue. Capitalised it ends by itself; written otherwise, its end must show, and none of its words is ordinary.

    Weak cues come before places and things as often: after them the words must be name-like.
    """
    if start and low[start].isalpha() and low[start - 1].isalnum():
        return
    titled = _TITLED.match(text, end)
    if titled and _is_name(titled.group(1)):
        return  # the form of address is an anchor of its own
    m = _CASED.match(text, end)
    if m:
        value = m.group()
        upper = value.isupper() and (weak or text[max(0, end - 20):end].isupper())
        if _is_name(value) and not (weak and ("," in value or not _namelike(value))) and (not upper or not weak and _NAME_ENDS.match(text, m.end())):
            out.append((m.start(), m.end(), "person_name"))
            return
    if weak:
        return
    m = _LOOSE.match(text, end)
    if not m:
        return
    value = m.group()
    if value.endswith("'s") and not _NAME_ENDS.match(text, m.end()):
        value = value[:-2]
    words = re.findall(r"[^\W\d_][\w'-]*", value)
    if not value.islower() and not value.isupper() and value[0].isupper() and words[-1][0].islower():
        return  # a capital at the beginning of a sentence
    if _is_name(value) and _NAME_ENDS.match(text, end + len(value)) and not any(_ordinary(w) for w in words):
        out.append((end, end + len(value), "person_name"))


# -- names without a cue -------------------------------------------------------------------

_RUN = re.compile(rf"{_T}(?: (?:[A-ZÀ-Þ]\.|{_T}))+")
#: Words before a name of a place, and words that places and undertakings are called by. Closed lists of the languages read.
_TO_PLACES = frozenset("in at from to near via the towards toward around outside inside across through throughout into onto visit visited visiting toward im in nach aus bei vom zum zur nahe am an au aux à en dans vers depuis desde hacia hasta cerca a el la los las al".split())
_PLACES = frozenset("san santa santo saint sankt los las el la le new old great upper lower north south east west nord sud süd ost hong rio costa puerto port porto fort mount mont monte lake lago isla cape bad villa buenos united royal national international".split())
_FIRMS = frozenset("inc ltd llc gmbh ag plc corp co company bank university college school institute hotel museum theatre theater group partners association society council committee university party club airlines airport station street road avenue park river valley county city island islands".split())


#: Words that stand right before a name and are none.
_LEADS = frozenset(c.split()[0].strip(",") for c in NAME_CUES if c[0].isalpha()) | frozenset(TITLES)
#: Articles and possessives: what follows them is a thing, also where things have capitals.
_ARTICLES = frozenset("the a an my our your his her their its der die das den dem des ein eine einen einem einer mein meine meinen meinem unser unsere le la les un une mon ma mes el los las un una mi su sus".split())


def _namelike(value: str) -> bool:
    """Whether no word is ordinary, a function word, or one that places and undertakings are called by; blobs of mixed case are no words."""
    words = [w for w in value.split(" ") if not w.endswith(".")]
    plain = [x for w in words for x in re.split(r"[-']", w)]
    if not words or any(not any(len(x) > 1 for x in re.split(r"[-']", w)) or _ordinary(w) for w in words):
        return False
    if any(len(x) > 1 and (x.lower() in NO_NAME or not re.fullmatch(r"(?:Mc|Mac|Di|De|Le|La|Van|Fitz)?[^\W\d_][^\W\d_A-ZÀ-ÖØ-Þ]*", x)) for x in plain):
        return False
    low = value.lower()
    return words[0].lower() not in _PLACES and words[-1].lower() not in _FIRMS and not any(c in low for c in ID_CUES if len(c) > 5)


def _free_name(text: str, start: int, end: int, out: list) -> None:
    """A run of two or three capitalised words, none of them ordinary, that isn't said to be a place or an undertaking."""
    value = text[start:end]
    while " " in value and ((first := value.split(" ")[0]).lower() in NO_NAME | _LEADS or _ordinary(first)):
        start += value.index(" ") + 1  # the first word of a sentence, or a word before the name
        value = text[start:end]
    if value.count(" ") > 2 or len([w for w in value.split(" ") if not w.endswith(".")]) < 2 or value.isupper() or not _namelike(value):
        return
    before = re.search(r"([^\W\d_]+)(,?) \Z", text[max(0, start - 16):start])
    after = re.match(r" ([^\W\d_]+)", text[end:end + 16])
    if before and not before.group(2) and before.group(1).lower() in _TO_PLACES | _ARTICLES or after and after.group(1).lower() in _FIRMS:
        return
    if not any(x.lower() in lexicon()[1] for w in value.split(" ") for x in w.split("-")) and not (before or after):
        return  # unknown words by themselves, as in headings and lists
    out.append((start, end, "person_name"))


def _titled(text: str, start: int, out: list) -> None:
    if start and (text[start - 1].isalnum() or text[start - 1] in "'-@."):
        return
    m = _TITLED.match(text, start)
    if m and m.group(1)[0].isupper():
        # the second word may begin the next sentence
        first = m.group(1).split(" ")[0]
        for name in (m.group(1), first) if len(first) > 2 else (m.group(1),):
            if _is_name(name):
                out.append((start, m.start(1) + len(name), "person_name"))
                return
    m = _TITLED_ANY.match(text, start)
    title = text[start:start + 4].lower()
    if m and title.startswith(("dr", "mr", "mrs", "ms", "mme", "herr", "herrn", "frau", "prof")) and _is_name(m.group(1)) and len(m.group(1)) > 2 and (text[start].islower() or m.group().isupper()):
        out.append((start, m.end(), "person_name"))


# -- all together ------------------------------------------------------------------------------


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what is found in the original text, without overlaps, in order."""
    if not text:
        return []
    plain, place = normalised(text)
    low = lowered(plain)
    out: list[tuple[int, int, str]] = []
    anchors = [(last + 1 - len(word), last + 1, word, kind) for last, (word, kinds) in automaton().iter(low) for kind in kinds if kind != "id" or _is_cue(low, last + 1 - len(word), last + 1)]
    cues = sorted(a[0] for a in anchors if a[3] == "id")
    #: Up to where each parser that may begin again inside a value has read.
    read = dict.fromkeys(("shape", "international", "national", "english", "french", "german", "spanish", "spelt", "iban", "card"), 0)

    def shape(name: str, pattern: re.Pattern, at: int, kind: str) -> bool:
        if at < read[name]:
            return False
        m = pattern.match(plain, at)
        if not m:
            return False
        read[name] = m.end()
        if kind == "phone" and _NOT_BEFORE.search(low[max(0, at - 14):at]):
            return True
        if name != "iban" or _valid_iban(m.group()):
            out.append((at, m.end(), kind))
        return True

    for start, end, word, kind in anchors:
        if kind == "digit":
            if start and plain[start - 1].isdigit():
                continue
            # the signs and letters that a number may begin with
            begin = start
            while begin and start - begin < 3 and (plain[begin - 1] in "+(- " or plain[begin - 1].isalpha()):
                begin -= 1
            for at in range(begin, start + 1):
                if shape("shape", _ID_SHAPES, at, "national_id"):
                    break
            for at in range(begin, start + 1):
                if shape("iban", _IBAN, at, "account"):
                    break
            shape("card", _CARD, start, "account")
            for at in (start - 1, start):
                if at >= 0 and shape("international", _INTERNATIONAL, at, "phone"):
                    break
            for at in (start - 1, start):
                if at >= 0 and shape("national", _NATIONAL, at, "phone"):
                    break
            if start >= read["english"]:
                read["english"] = max(read["english"], _english(plain, start, out, read["english"]))
            shape("french", _FRENCH, start, "street_address")
        elif kind == "at":
            _email(plain, start, word, out)
        elif kind == "id":
            after = bisect_right(cues, start)
            _identifier(plain, low, start, end, cues[after] if after < len(cues) and cues[after] >= end else len(plain), out)
        elif kind == "phone":
            _phone_after(plain, end, out)
        elif kind == "account":
            m = _ACCOUNT_AFTER.match(plain, end)
            if m:
                out.append((m.start(1), m.end(1), "account"))
        elif kind == "address":
            _address_after(plain, low, end, out)
        elif kind == "title":
            _titled(plain, start, out)
        elif kind == "spelt":
            if not (start and plain[start - 1].isalnum()):
                shape("spelt", _SPELT, start, "phone")
        elif kind == "german":
            head = start
            while head > read["german"] and (plain[head - 1].isalnum() or plain[head - 1] in "_-"):
                head -= 1
            while head < start and not plain[head].isalpha():
                head += 1
            if start > head >= read["german"] and not shape("german", _GERMAN, head, "street_address"):
                # this word was read from its beginning; its other anchors lead to the same
                read["german"] = end if end < len(plain) and (plain[end].isalnum() or plain[end] in "_-") else max(read["german"], head)
        elif kind == "spanish":
            shape("spanish", _SPANISH, start, "street_address")
        else:
            _name_after(plain, low, start, end, kind == "weak", out)
    for m in _RUN.finditer(plain):
        _free_name(plain, m.start(), m.end(), out)
    return _settled(out, place, len(text))


def _settled(found: list, place: list[int] | None, size: int) -> list[tuple[int, int, str]]:
    """Values without overlaps: the earlier kind first, then the longer, then the one before. Kept ones stay in order, so each test is a search."""
    starts: list[int] = []
    kept: list[tuple[int, int, str]] = []
    for start, end, kind in sorted(set(found), key=lambda x: (PRIORITY[x[2]], x[0] - x[1], x[0])):
        at = bisect_right(starts, start)
        if (at == 0 or kept[at - 1][1] <= start) and (at == len(kept) or kept[at][0] >= end):
            starts.insert(at, start)
            kept.insert(at, (start, end, kind))
    kept = [x for x in kept if x[2] != "account"]
    if place is not None:
        kept = [(place[a], place[b - 1] + 1, k) for a, b, k in kept]
    return kept


def redact(text: str) -> str:
    """The text with [EMAIL], [PHONE], [NATIONAL_ID], [STREET_ADDRESS] and [PERSON_NAME] in place of what was found."""
    out, at = [], 0
    for start, end, kind in spans(text):
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def _finding(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        global _folder
        _folder = folder
        for batch in batches:
            found = {(m, kind) for m, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for p in parts or () for _, _, kind in spans(part_text(p))}
            rows = sorted(found, key=str)
            yield pa.record_batch({"msg_id": pa.array([r[0] for r in rows], pa.int64()), "pii_kind": pa.array([r[1] for r in rows], pa.string())})

    return run


def found(messages: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """(msg_id, pii_kind), once each."""
    return messages.select(F.col("msg_id").cast("long"), "parts").mapInArrow(_finding(tokenizers), "msg_id long, pii_kind string").distinct()


def _redacting(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        global _folder
        _folder = folder
        for batch in batches:
            texts = [None if ps is None else [None if p is None else redact(part_text(p)) for p in ps] for ps in batch.column(1).to_pylist()]
            yield pa.record_batch({"msg_id": batch.column(0), "texts": pa.array(texts, pa.list_(pa.string()))})

    return run


def redacted(messages: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """(msg_id, texts): the text of each part with placeholders. One scan, no shuffle."""
    return messages.select(F.col("msg_id").cast("long"), "parts").mapInArrow(_redacting(tokenizers), "msg_id long, texts array<string>")
