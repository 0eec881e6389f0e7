"""Problem 2: personal information in free text, found and replaced by typed placeholders.

Method: a skip-chain conditional random field (see ``crf``).  Texts are folded to one
stored form (full width, odd spaces, look-alike letters), cut into tokens and labelled
by kind.  Patterns (something shaped like a phone number, a mail address and so on)
are features of the tokens, not decisions.  Repeated or similar tokens of a document
are linked, and loopy message passing makes their labels agree.  A short exact check
follows: a mail address needs an at sign or its spelling, a phone number enough digits,
an address a digit.

The model is trained from the labelled sample of the data (expected texts aligned with
their notes, at most ``SAMPLE`` rows in the order of a hash of the id) together with the
annotated sentences below, so it also works where the sample is tiny or empty.  The
trained weights are broadcast: their number is bounded by the sample, not by the data.
The potential of a link comes from the labels that linked tokens bear in the sample, its
strength (none allowed) from notes that the model has not seen.

Null, empty and blank texts hold nothing and stay as they are.  Existing ``[REDACTED]``
tags are no entity.  Repeated rows are judged alike.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.functions.text import is_blank
from veilwork.llm.crf import SkipChainCRF
from veilwork.llm.lookalike import canonical
from veilwork.sources.tables import spread, table

#: Most labelled rows that the model is trained on.
SAMPLE = 1500
#: Longest stretch behind a tag, in characters; a longer one says that text and expected text do not fit there.
LONGEST = 160
#: Most known names of each list that are features, in the order of a hash.
NAMES = 200_000
#: Strengths of the skip potential that are tried on held-out notes.
STRENGTHS = (0.0, 0.1, 0.25, 0.5, 1.0)
#: Least marginal probability of a token to belong to an entity.
THRESHOLD = 0.12
KINDS = ("NAME", "EMAIL", "PHONE", "ID_NUMBER", "ADDRESS")
_CLASSES = (*KINDS, "DATE")
LABELS = ["O", *_CLASSES]
_KIND_OF = np.arange(len(LABELS))

# Cue words of the languages served, by what they announce.
CUES = {
    "title": "mr mrs ms miss dr prof herr frau mme mlle madame monsieur don doña señor señora sr sra nurse sister pt patient patiente paciente dwr dwa md",
    "kin": "wife husband daughter son mother father brother sister aunt uncle cousin neighbour carer mère père fille fils mari femme hija hijo esposa esposo madre padre tochter sohn mutter vater ehefrau ehemann",
    "by": "by from with signed dictated seen reviewed cc re gez par vu von vom por firmado signé courrier interpreter named",
    "phone": "tel tél phone fax mobile mobil cell call ring voicemail text telefon téléphone portable teléfono móvil llamar rappeler rückruf erreichbar landline ext handy",
    "mail": "mail email mailto contact correo courriel écrire escribir login writing send",
    "id": "mrn ssn nhs id dni nie nif passport licence license insurance security social sécurité sociale hospital medical record number versichertennummer vers krankenversicherung pasaporte passeport ausweis ni identity identité identität identidad akte dossier ficha file",
    "thing": "order lot batch device serial specimen form sheet printout ticket accession tube pump model room bed ward version ref range invoice",
    "street": "street st road rd avenue ave lane ln drive dr close court ct place way blvd boulevard terrace hill square crescent calle avenida plaza paseo rue avenue allée chemin straße strasse gasse weg platz allee flat apt unit",
    "live": "lives address moved home post anschrift wohnhaft adresse domicile domicilio dirección shares steps deliver ambulance",
    "eponym": "disease syndrome sign test score scale serology index spots tube catheter fracture reflex law method criteria manoeuvre",
    "place": "hospital clinic infirmary unit centre center ward hall house market mill bay general rehabilitation school university institute",
}
_CUE_OF: dict[str, list[str]] = {}
for _name, _words in CUES.items():
    for _w in _words.split():
        _CUE_OF.setdefault(_w, []).append(f"cue:{_name}")

# Annotated sentences, {kind|stretch}; written from general knowledge of how such things are mentioned, not from any table.
SEEDS = """
My name is {NAME|Clara Benning} and my brother is {NAME|Tom Benning}. Our doctor, Dr. {NAME|Yilmaz}, knows us well.
Interview with Mrs {NAME|Adaeze Obi}, then with Mr. {NAME|Obi}. {NAME|Obi, Adaeze} signed the consent form. Nurse {NAME|Fenn} was there.
Prof. {NAME|H. J. Marlow} operated, assisted by {NAME|Priya Nair}, MD. Regards, {NAME|marlow}. Minutes taken by {NAME|P. Nair}.
The son ({NAME|Lewis}) and his aunt {NAME|Grace O'Malley} came along; {NAME|LEWIS HART} drove. Ask for {NAME|Hart-Benning}.
Herr {NAME|Thomas Krüger} kam mit seiner Frau {NAME|Inge Krüger}. Rückfragen an Dr. {NAME|Vogt}. Der Sohn {NAME|Jonas} holt ab.
Monsieur {NAME|Paul Girard} et sa fille {NAME|Lucie} sont venus. Docteur {NAME|Lambert} absent. Avec {NAME|Anne de Brisson}, sa voisine.
La señora {NAME|Carmen Ruiz Vidal} vino con su hijo {NAME|Andrés}. Atendida por la Dra. {NAME|Molina}. Habló {NAME|RUIZ, CARMEN}.
{NAME|Tom Benning}: "Thank you." Then {NAME|Clara} left. Is {NAME|Marlow} on call? Dear {NAME|Adaeze}, see you soon.
You can write me at {EMAIL|clara.benning@inbox.example} or {EMAIL|tom_b+news@web.example.net}. Mail: {EMAIL|INFO@FENN.TEST}
Mein Postfach ist {EMAIL|t.krueger@brief.example}. Mon adresse est {EMAIL|paul.girard@lettre.example}; escribe a {EMAIL|cruiz7@buzon.test}
My address is {EMAIL|clara AT inbox DOT example} or {EMAIL|tom (at) web (dot) example}, also {EMAIL|hart @ box.example}.
Phone {PHONE|(555) 555-0123} or {PHONE|+1 555 555 0188 ext 4}. Office: {PHONE|020 7946 0321}, cell {PHONE|07700 900321}.
Ruf mich an: {PHONE|030 2312 5678}. Mon numéro est le {PHONE|+33 1 99 00 45 67}. Mi número es {PHONE|+34 100 45 67 89}. Fax {PHONE|555-555-0177}
He answers on {PHONE|5555550111} in the evening; tel: {PHONE|555.555.0133}; Mobil {PHONE|0151 23125000}; {PHONE|(555)5550166} works too.
MRN: {ID_NUMBER|7788123}, NHS {ID_NUMBER|943 476 5919}, SSN {ID_NUMBER|900-55-4321}. Her medical record number is {ID_NUMBER|H778812}.
Passport no. {ID_NUMBER|P44556677}, licence {ID_NUMBER|BENNI901015CB9}, insurance ID {ID_NUMBER|XW-556677-01}, national insurance {ID_NUMBER|QQ 55 66 77 A}.
Versichertennummer {ID_NUMBER|B556677889}, Ausweis {ID_NUMBER|L01X00T47}. DNI {ID_NUMBER|55667788-K}. Sécurité sociale {ID_NUMBER|2 85 05 99 123 456 78}.
His social security number, {ID_NUMBER|900554321}, and hospital ID {ID_NUMBER|00778812} were checked. MRN#{ID_NUMBER|8812776}
We live at {ADDRESS|14 Juniper Street} in the old town. New flat: {ADDRESS|Apt 9, 220 Orchard Avenue, Brookfield, NY 00456}
My parents' house is {ADDRESS|7 Lime Close, Brookfield}. Send it to {ADDRESS|88B Ferry Road}, or {ADDRESS|3 north quay lane, brookfield}.
Ich wohne {ADDRESS|Lindenstraße 21, 00456 Neuburg}. Anschrift {ADDRESS|Kirchweg 4a}. Früher {ADDRESS|Am Anger 6, 00456 Neuburg}.
J'habite {ADDRESS|8 rue des Lilas, 00456 Montclair}. Adresse: {ADDRESS|25 bis avenue du Port}. Vivo en {ADDRESS|Calle Sol 9, 4.º A, 00456 Río Alto} y antes en {ADDRESS|Avda. del Mar 31}.
Their shop stands at {ADDRESS|500 Mason Blvd, Suite 3, Brookfield NY}; the office at {ADDRESS|19 Abbey Court}; the flat at {ADDRESS|Unit 5, 61 Dale Crescent, Brookfield}.
Born {DATE|04/05/1961}. Admitted {DATE|12/11/2021}, discharged {DATE|15-11-2021}. Next visit {DATE|1/3/24}: weight 71, height 170.
Invoice 55667788 paid, order 4455-66, model X900, serial 9988776655, version 3.1, room 12, bus line 40, bed 7.
The batch B556677 and lot 22-0987 were returned; specimen 4455667788; ticket 90055; form F-22; page 3 of 14; sheet 12; tube 8.
Parkinson disease, Crohn disease and Down syndrome were ruled out. Babinski reflex normal. Foley catheter, Bence Jones protein, Barthel index 80.
Transferred from Saint Luke Hospital to Riverside Clinic, North Wing. The Harbour Centre, Oak House and Queen Square ward were full.
Will you go in May? Mark your form. Grace before meals. The rose fades, joy returns, a frank talk, an art class, the dawn.
Blood pressure 135/85. BP 118/76, pulse 64, oxygen 97 %, 37.2 degrees. Give 250 mg at 08:00 and 20:00, 2 tablets, 10 ml, 1.5 mg per kg.
Text with [REDACTED] and [REDACTED] in it. Monday morning the doctor and the nurse spoke to the patient and the family.
"""

_POSSESSIVE = ("'s", "’s")
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+|[^\w\s]|_")
_AT = r"(?:@|[(\[]\s?at\s?[)\]]|\bAT\b|\bat\b)"
_DOT = r"(?:\.|[(\[]\s?dot\s?[)\]]|\s(?:DOT|dot)\s)"
#: Spelled so that nothing but a mail address fits.  The look-behind only spares starts inside a run that has failed.
_MAIL = re.compile(rf"(?<![\w.+%-])[\w.+%-]+(?:\s?@\s?[\w-]+(?:\.[\w-]+)+|\s?[(\[]\s?at\s?[)\]]\s?[\w-]+(?:{_DOT}[\w-]+)+|\s(?:AT|at)\s[\w-]+(?:\s(?:DOT|dot)\s[\w-]+)+)")
# Street and house number by language, each behind stretches of which one must occur in the lower-case text.
_HOUSES = {
    " st;road; rd; ave; lane; ln; dr; cl; c;place; pl; way;boulevard;blvd; ter; hill; sq":
        r"\b\d{1,4}[A-Za-z]? (?:[^\W\d_][\w'’.]*\s){1,4}?(?i:street|st|road|rd|avenue|ave|lane|ln|drive|dr|close|court|ct|place|pl|way|blvd|boulevard|terrace|ter|hill|square|crescent)\b",
    " rue ; avenue ; allée ; chemin ; boulevard ; place ; impasse ; quai ": r"\b\d{1,4}(?: bis)?,? (?i:rue|avenue|allée|chemin|boulevard|place|impasse|quai) [^\W\d_][\w'’ -]{2,30}",
    "calle;c/;avenida;avda;plaza;paseo;camino": r"(?i:calle|c/|avenida|avda\.?|plaza|paseo|camino) ?[^\n,\d]{2,30} \d{1,4}",
    "straße ;strasse ;str. ;gasse ;weg ;platz ;allee ;damm ;ring ;ufer ;am ;an der ;im ;auf dem ": r"(?<![^\W\d_])[^\W\d_]+(?i:straße|strasse|str\.|gasse|weg|platz|allee|damm|ring|ufer) \d{1,4}[a-z]?\b|\b(?:Am|An der|Im|Auf dem) [^\W\d_]+ \d{1,4}[a-z]?\b",
}
_ID_TAIL = r"[.:#\s]{0,3}[A-Za-z]{0,2}[ -]?\d[\dA-Za-z]*(?:[ -]\d[\dA-Za-z]*)*(?:-[A-Za-z])?\b"
_ID_WORDS = ("mrn", "ssn", "nhs", "number", "n.º", "nº", "n°", "passport", "licen", "dni", "versichertennummer", "sociale")
PATTERNS = {
    "rx:email": _MAIL,
    "rx:date": re.compile(r"(?<![\d/-])\d{1,2}[-/.]\d{1,2}[-/.](?:\d{4}|\d{2})(?![\d/-])|(?<!\d)\d{4}-\d{2}-\d{2}(?!\d)"),
    "rx:phone": re.compile(
        r"(?<![\w.-])(?:\+\d{1,3}[ .-]?)?(?:\(0?\d{1,5}\)[ .-]?)?\d{1,5}(?:[ ./-]\d{2,6}){1,5}(?: ?(?:ext|x)\.? ?\d{1,5})?(?![\w-])"
        r"|(?<![\w.-])\+?\d{10,11}(?![\w-])|(?<![\w.-])\(\d{2,5}\) ?\d{5,8}(?!\d)"
    ),
    "rx:nanp": re.compile(r"(?<![\w.-])(?:\+?1[ .-]?)?\(?\d{3}\)?[ .-]?555[ .-]?\d{4}(?:\s?ext\.?\s?\d+)?(?!\d)"),
    "rx:ssn": re.compile(r"(?<![\w-])\d{3}[- ]\d{2}[- ]\d{4}(?![\w-])"),
    # In two parts, as the short words begin everywhere and are looked for by their first letter.
    "rx:idword": re.compile(
        rf"(?i)(?:\bMRN|\bSSN|\bNHS|number|n\.º|nº|n°|passport|licen[cs]e|\bDNI|Versichertennummer|sociale){_ID_TAIL}"
    ),
    "rx:idno": re.compile(rf"[IiNn](?<!\w.)(?:(?<=[Ii])[Dd]|(?<=[Nn])[RrOo]){_ID_TAIL}"),
    "rx:thing": re.compile(
        r"(?i)\b(?:order|lot|batch|serial|specimen|form|sheet|printout|ticket|accession|tube|model|room|range|page|formular|ausdruck)\b[\s:#]{0,2}[A-Z]{0,3}-?\d[\d-]*"
    ),
    "rx:house": re.compile("|".join(_HOUSES.values())),
    "rx:zip": re.compile(r"\b[A-Z]{2} 0\d{4}\b|\b0\d{4} [^\W\d_]{4,}"),
    "rx:tag": re.compile(r"\[REDACTED\]"),
}
_HOUSE_GATED = [(tuple(gate.split(";")), re.compile(pattern)) for gate, pattern in _HOUSES.items()]
_WIDTHLESS = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff\u0300-\u036f]")
_DIGITS = re.compile(r"\d")


def fold(text: str) -> str:
    """One stored form of a text (see ``lookalike``); line breaks stay."""
    return canonical(text)


def fold_map(text: str) -> tuple[str, list[int]]:
    """The folded text and, for each of its positions, the position in ``text``."""
    if text.isascii():
        return text, list(range(len(text) + 1))
    out: list[str] = []
    back: list[int] = []
    for m in re.finditer(r"\s+|\S+", text):
        _place(m.group(), m.start(), out, back)
    return "".join(out), [*back, len(text)]


def _place(chunk: str, at: int, out: list[str], back: list[int]) -> None:
    """Fold one chunk and place its characters: halved where the halves fold on their own, else by its prefixes."""
    new = canonical(chunk)
    if new == chunk:
        out.append(new)
        back.extend(range(at, at + len(chunk)))
        return
    if len(chunk) > 8:
        middle = len(chunk) // 2
        for cut in (c for d in range(min(24, middle)) for c in (middle - d, middle + d)):
            if _WIDTHLESS.match(chunk, cut):
                continue  # a mark or a character without width stays with what it follows
            if canonical(chunk[:cut]) + canonical(chunk[cut:]) == new:
                _place(chunk[:cut], at, out, back)
                _place(chunk[cut:], at + cut, out, back)
                return
    out.append(new)
    ends = [len(canonical(chunk[: k + 1])) for k in range(len(chunk))]
    back.extend(at + min(bisect_right(ends, p), len(chunk) - 1) for p in range(len(new)))


def _shape(token: str) -> str:
    if token.isdigit():
        return f"9x{min(len(token), 13)}"
    if token.isalpha():
        if token.islower():
            return "x" if len(token) > 1 else "x1"
        if token.isupper():
            return "X" if len(token) > 3 else f"X{len(token)}"
        return "Xx" if token[1:].islower() else "XxX"
    return "'" if "'" in token or "’" in token else token


class TypeFeatures:
    """Features of a token type; ``first`` and ``last`` are known names, folded to lower case."""

    def __init__(self, first: frozenset[str], last: frozenset[str]):
        self.first, self.last = first, last

    def __call__(self, token: str) -> list[str]:
        low = token.casefold()
        out = ["1", f"w:{re.sub(r'[0-9]', '9', low)}", f"sh:{_shape(token)}", *_CUE_OF.get(low, ())]
        if token[0].isalpha():
            out += [f"p3:{low[:3]}", f"s3:{low[-3:]}", f"s4:{low[-4:]}"]
            capital = token[0].isupper()
            for name, known in (("first", self.first), ("last", self.last)):
                if low in known:
                    out += [f"list:{name}", f"list:{name}{'C' if capital else 'c'}"]
        return out


def tokenize(text: str) -> tuple[list[str], list[int], list[int]]:
    toks, starts, ends = [], [], []
    for m in _TOKEN.finditer(text):
        toks.append(m.group())
        starts.append(m.start())
        ends.append(m.end())
    return toks, starts, ends


@lru_cache(8192)
def _found(name: str, text: str) -> tuple[tuple[int, int], ...]:
    """Bounds of what one pattern matches; a phone number has nine to sixteen digits and is no date."""
    spans = [m.span() for m in PATTERNS[name].finditer(text)]
    if name == "rx:phone":
        spans = [(a, b) for a, b in spans if 9 <= sum(c.isdigit() for c in text[a:b]) <= 16]
    return tuple(spans)


def positional(text: str, toks: list[str], starts: list[int], ends: list[int]) -> list[tuple[int, str]]:
    """(token position, feature): patterns, line starts, sentence starts, glued neighbours."""
    out: list[tuple[int, str]] = []
    digits = _DIGITS.search(text) is not None
    low = text.lower() if digits else ""
    searches: list[tuple[str, object]] = [(name, None) for name in PATTERNS if name != "rx:house"]
    searches += [("rx:house", p) for gate, p in _HOUSE_GATED if digits and any(map(low.__contains__, gate))]
    for name, pattern in searches:
        if name == "rx:email":
            if "@" not in text and "at)" not in text and "at]" not in text and " DOT " not in text and " dot " not in text:
                continue
        elif name == "rx:tag":
            if "[REDACTED]" not in text:
                continue
        elif not digits or name == "rx:idword" and not any(map(low.__contains__, _ID_WORDS)):
            continue
        for start, end in _found(name, text) if pattern is None else [m.span() for m in pattern.finditer(text)]:
            if name == "rx:phone" and PATTERNS["rx:date"].fullmatch(text, start, end):
                continue
            a, b = bisect_left(starts, start), bisect_left(starts, end)
            feature = "rx:idword" if name == "rx:idno" else name
            for k in range(a, b):
                out.append((k, f"{feature}:{'B' if k == a else 'I'}"))
            if a:
                out.append((a - 1, f"{feature}:before"))
    for k in range(len(toks)):
        if k == 0 or "\n" in text[ends[k - 1] : starts[k]]:
            out.append((k, "line"))
        elif toks[k - 1] in ".!?:;":
            out.append((k, "sent"))
        if k and ends[k - 1] == starts[k]:
            out.append((k, "glued"))
    return out


def skip_links(toks: list[str]) -> list[tuple[int, int]]:
    """Links from each repeated or similar (case, possessive) token to the occurrence before and to the first one."""
    last: dict[str, int] = {}
    first: dict[str, int] = {}
    out = []
    for k, t in enumerate(toks):
        if (len(t) < 3 if t[0].isalpha() else not (t.isdigit() and len(t) >= 4)) :
            continue
        key = t.casefold()
        key = key[:-2] if key.endswith(_POSSESSIVE) else key
        f = first.setdefault(key, k)
        for j in {last.get(key, k), f}:
            if j != k and (t[0].isdigit() or t[0].isupper() or toks[j][0].isupper()):
                out.append((j, k))
        last[key] = k
    return out


def _gold_kind(stretch: str, before: str) -> str | None:
    """Kind of an expected stretch, told by its form and what stands before it."""
    if PATTERNS["rx:date"].fullmatch(stretch.strip()):
        return "DATE"
    if re.search(rf"@|{_AT}.*{_DOT}", stretch):
        return "EMAIL"
    digits = sum(c.isdigit() for c in stretch)
    if not digits:
        return "NAME" if any(c.isalpha() for c in stretch) else None
    if PATTERNS["rx:house"].search(stretch) or (re.search(r"[^\W\d_]{3,}", re.sub(r"ext", "", stretch)) and digits < 9):
        return "ADDRESS"
    if PATTERNS["rx:ssn"].fullmatch(stretch.strip()):
        return "ID_NUMBER"
    words = re.findall(r"[^\W\d_]+", before[-40:].casefold())[-4:]
    if any("cue:phone" in _CUE_OF.get(w, ()) for w in words[-3:]):
        return "PHONE"
    if re.match(r"[A-Z]", stretch.strip()) or any("cue:id" in _CUE_OF.get(w, ()) for w in words):
        return "ID_NUMBER"
    if 9 <= digits <= 16:
        return "PHONE"
    return "ID_NUMBER" if digits >= 5 else None


def align(expected: str, text: str) -> list[tuple[int, int, str]] | None:
    """Spans of ``text`` that ``expected`` replaces by tags; None where the two do not fit."""
    tag = r"\[REDACTED\](?:\s*\[REDACTED\])*"
    at, spans, parts = 0, [], re.split(tag, expected.rstrip())
    for k, part in enumerate(parts):
        if k == 0:
            lead = len(expected.rstrip()) and text.startswith(part)
            if not lead:
                return None
            at = len(part)
            continue
        if part == "" and k == len(parts) - 1:
            to = len(text.rstrip())
        elif (to := text.find(part, at + 1)) < 0:
            return None
        spans.append((at, to))
        at = to + len(part)
    out = []
    for a, b in spans:
        stretch = text[a:b]
        if "[REDACTED]" in stretch or len(stretch) > LONGEST:
            continue
        if kind := _gold_kind(stretch, text[:a]):
            out.append((a, b, kind))
    return out


def _labels(toks, starts, ends, spans) -> list[int]:
    y = [0] * len(toks)
    for a, b, kind in spans:
        for k in range(bisect_left(starts, a), bisect_left(starts, b)):
            y[k] = LABELS.index(kind)
    return y


def _example(text: str, spans) -> list[tuple[list[str], list[list[str]], list[int]]]:
    """Training sequences of one text, cut at line ends and after long stretches."""
    toks, starts, ends = tokenize(text)
    if not toks:
        return []
    extra: list[list[str]] = [[] for _ in toks]
    for k, f in positional(text, toks, starts, ends):
        extra[k].append(f)
    y, out, at = _labels(toks, starts, ends, spans), [], 0
    for k in range(1, len(toks) + 1):
        if k == len(toks) or (k - at >= 60 and y[k] == 0 and y[k - 1] == 0):
            out.append((toks[at:k], extra[at:k], y[at:k]))
            at = k
    return out


def _seed_examples() -> list:
    out = []
    for line in SEEDS.strip().splitlines():
        text, spans, at = "", [], 0
        for m in re.finditer(r"\{(\w+)\|([^}]*)\}", line):
            text += line[at : m.start()]
            spans.append((len(text), len(text) + len(m.group(2)), m.group(1)))
            text, at = text + m.group(2), m.end()
        out += _example(text + line[at:], spans)
    return out


def train(pairs: list[tuple[str, str]], first: set[str], last: set[str], rounds: int = 60, l2: float = 1e-3) -> SkipChainCRF:
    """Fit the model on (expected, text) pairs and the annotated sentences."""
    examples, held = _seed_examples(), []
    for n, (expected, text) in enumerate(pairs):
        a, b = fold(expected), fold(text)
        if (spans := align(a, b)) is None:
            continue
        (held if n % 8 == 7 else examples).extend(_example(b, spans) if n % 8 != 7 else [(b, spans)])
    model = SkipChainCRF(LABELS, TypeFeatures(frozenset(first), frozenset(last)))
    model.fit(examples, rounds, l2)
    model.compact()
    model.pair = link_potential(examples)
    if len(held) >= 8:
        model.skip = max(STRENGTHS, key=lambda w: (_likelihood(model, held, w), -w))
    return model


def link_potential(examples) -> np.ndarray:
    """Log of how much more often linked tokens of the examples bear two labels than unlinked ones would, smoothed and centred."""
    n = np.full((len(LABELS), len(LABELS)), 0.0)
    for toks, _, y in examples:
        for a, b in skip_links(toks):
            n[y[a], y[b]] += 0.5
            n[y[b], y[a]] += 0.5
    share = n.sum(1) + 1
    expected = np.outer(share, share) / share.sum()
    return np.clip(np.log((n + expected) / (2 * expected)), -2, 2)


def _likelihood(model: SkipChainCRF, held, weight: float) -> float:
    """Mean log marginal of the true labels on held-out notes under one strength of the skip potential."""
    model.skip = weight
    total = tokens = 0.0
    for (_, spans), (toks, starts, ends, p) in zip(held, label_texts(model, [t for t, _ in held])):
        if toks:
            total += float(np.log(np.maximum(p[np.arange(len(toks)), _labels(toks, starts, ends, spans)], 1e-9)).sum())
            tokens += len(toks)
    return total / max(1.0, tokens)


def label_texts(model: SkipChainCRF, folded: list[str]):
    """Per text: tokens, starts, ends and label marginals."""
    parts = [tokenize(text) for text in folded]
    fields = model.emissions([(part[0], positional(text, *part)) for text, part in zip(folded, parts)])
    docs = [(field, skip_links(part[0])) for field, part in zip(fields, parts)]
    return [(*part, p) for part, p in zip(parts, model.marginals(docs, _KIND_OF))]


def decide(p: np.ndarray) -> np.ndarray:
    """Label of each token: a miss costs more than a false alarm, so an entity needs ``THRESHOLD`` only."""
    best = p[:, 1:].argmax(1) + 1
    return np.where(1 - p[:, 0] >= THRESHOLD, best, 0)


def entities(text: str, toks, starts, ends, p: np.ndarray) -> list[tuple[int, int, str]]:
    """Checked spans (start, end, kind) in the folded text."""
    if not toks:
        return []
    best = decide(p)
    mails = None
    out, k = [], 0
    while k < len(best):
        kind = _KIND_OF[best[k]]
        if kind == 0:
            k += 1
            continue
        j = k + 1
        while j < len(best) and _KIND_OF[best[j]] == kind:
            j += 1
        name, a, b = _CLASSES[kind - 1], starts[k], ends[j - 1]
        if name in ("NAME", "EMAIL") and mails is None:
            mails = _found("rx:email", text)
        for x, y in mails or ():
            if name in ("NAME", "EMAIL") and a < y and x < b:  # a name inside a mail address is none
                name, a, b = "EMAIL", min(a, x) if name == "EMAIL" else x, max(b, y) if name == "EMAIL" else y
                while j < len(best) and starts[j] < b:
                    j += 1
                break
        for x, y in _grown(text, name):
            if a < y and x < b:  # a number is masked as a whole
                a, b = min(a, x), max(b, y)
                while j < len(best) and starts[j] < b:
                    j += 1
                tokens = slice(bisect_left(starts, a), j)
                name = LABELS[int(p[tokens, 1:].sum(0).argmax()) + 1]
                break
        if name in KINDS and _plausible(name, text[a:b]) and not (name != "EMAIL" and _in_blob(text, a)):
            out.append((a, b, name))
        k = j
    return out


_WHOLE = {"PHONE": ("rx:nanp", "rx:phone"), "ID_NUMBER": ("rx:ssn",)}


def _grown(text: str, kind: str) -> list[tuple[int, int]]:
    """Stretches that stand or fall as one number."""
    spans = [x for name in _WHOLE.get(kind, ()) for x in _found(name, text)]
    return [(a, b) for a, b in spans if kind != "PHONE" or 9 <= sum(c.isdigit() for c in text[a:b]) <= 16]


_ENCODED_LEFT = re.compile(r"[A-Za-z0-9+/_-]*\Z")
_ENCODED_RIGHT = re.compile(r"[A-Za-z0-9+/_-]*")
_TURN = re.compile(r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


def _in_blob(text: str, at: int) -> bool:
    """Inside encoded data: more than 40 characters of the base64 or hex alphabet that mix letters, cases and digits as
    only encodings do, or a number longer than any.  Separators of fields and other scripts end such a run."""
    left = _ENCODED_LEFT.search(text[max(0, at - 80) : at]).group()
    run = left + _ENCODED_RIGHT.match(text[at : at + 81]).group()
    return len(run) > 40 and (run.isdigit() or len(_TURN.findall(run)) >= 0.22 * len(run))


def _plausible(kind: str, stretch: str) -> bool:
    digits = sum(c.isdigit() for c in stretch)
    if kind == "EMAIL":
        return "@" in stretch or _MAIL.search(stretch) is not None
    if kind == "PHONE":
        return digits >= 7
    if kind == "ID_NUMBER":
        return digits >= 4
    if kind == "ADDRESS":
        return digits >= 1 and re.search(r"[^\W\d_]{2}", stretch) is not None
    return re.search(r"[^\W\d_]{2}", stretch) is not None and stretch != "REDACTED"


def fit_from_tables(expected: DataFrame, notes: DataFrame, names: DataFrame, sample: int = SAMPLE) -> SkipChainCRF:
    """Train from the labelled sample: at most ``sample`` rows reach the driver."""
    chosen = (
        expected.where("id IS NOT NULL AND text IS NOT NULL").select("id", F.col("text").alias("expected"))
        .orderBy(F.xxhash64("id"), "id", "expected").limit(sample)
    )
    rows = (
        notes.where("text IS NOT NULL").select("id", "text").join(F.broadcast(chosen), "id")
        .orderBy(F.xxhash64("id"), "id", "expected").collect()
    )
    first: set[str] = set()
    last: set[str] = set()
    for lists, into in ((("men", "women"), first), (("last",), last)):
        each = F.concat(*[F.coalesce(F.col(f"names.{x}"), F.expr("CAST(array() AS array<string>)")) for x in lists])
        known = names.where("names IS NOT NULL").select(F.explode(each).alias("n")).where("n IS NOT NULL").distinct()
        into.update(r.n.strip().casefold() for r in known.orderBy(F.xxhash64("n"), "n").limit(NAMES).collect() if r.n.strip())
    return train([(r.expected, r.text) for r in rows], first, last)


def _entity_udf(shared, masked: bool):
    spans_type = T.ArrayType(T.StringType())

    @F.arrow_udf(T.StringType() if masked else spans_type)
    def run(texts: pa.Array) -> pa.Array:
        model, out = shared.value, []
        values = texts.to_pylist()
        for at in range(0, len(values), 512):
            part = [v or "" for v in values[at : at + 512]]
            maps = [fold_map(v) for v in part] if masked else None
            folded = [m[0] for m in maps] if masked else [fold(v) for v in part]
            for n, (text, labelled) in enumerate(zip(folded, label_texts(model, folded))):
                spans = entities(text, *labelled)
                if not masked:
                    out.append(sorted({k for _, _, k in spans}))
                    continue
                raw, back, pieces, done = part[n], maps[n][1], [], 0
                for a, b, kind in spans:
                    pieces += [raw[done : back[a]], f"[{kind}]"]
                    done = back[b - 1] + 1
                    while done < back[b] and _WIDTHLESS.match(raw, done):
                        done += 1
                out.append("".join([*pieces, raw[done:]]))
        return pa.array(out, pa.string() if masked else pa.list_(pa.string()))

    return run


def _model(spark: SparkSession, sf_dir: str):
    model = fit_from_tables(*(table(spark, sf_dir, t) for t in ("expected_notes", "test", "known_names")))
    return spark.sparkContext.broadcast(model)


def find_kinds(df: DataFrame, shared, key: str = "id", column: str = "text") -> DataFrame:
    """(key, kind): one row a row and kind that occurs in it; no shuffle."""
    base = df.where(~is_blank(F.col(column))).select(F.col(key).alias("id"), F.col(column).alias("text"))
    kinds = _entity_udf(shared, masked=False)(F.col("text"))
    return spread(base, "id").select(F.col("id").alias(key), F.explode(kinds).alias("kind"))


def mask_entities(df: DataFrame, shared, key: str = "id", column: str = "text") -> DataFrame:
    """(key, masked): every row with its entities replaced by ``[KIND]``."""
    text = F.col(column)
    base = spread(df.select(F.col(key).alias("id"), text.alias(column)), "id")
    masked = F.coalesce(F.when(~is_blank(text), _entity_udf(shared, masked=True)(F.when(~is_blank(text), text))), text)
    return base.select(F.col("id").alias(key), masked.alias("masked"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_kinds(table(spark, sf_dir, "test"), _model(spark, sf_dir))


def p2_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_entities(table(spark, sf_dir, "test"), _model(spark, sf_dir))


QUERIES = {"p2_found": p2_found, "p2_masked": p2_masked}
ORACLE: dict[str, str] = {}
