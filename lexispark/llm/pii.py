"""Personal data: surrogates (operator 2).

Found: e-mail addresses, phone numbers (international, or national after a word
such as "call"), payment cards (issuer prefix and check digit), IBANs (check
digits), IPv4 and IPv6 addresses, national numbers (ddd-dd-dddd), secrets after
their names (token, key, password, Bearer ...), names after titles, and every other
capitalised use, in the same document, of a part of such a name. Each is replaced by one
of its own type and form, drawn with a secret key:

* The letters and digits of a value are one number in a mixed-radix system
  that fixes what stays: lengths, separators, case, script, vowels and
  consonants, the issuer's digit. A keyed Feistel network permutes those numbers, so
  different values of one form get different surrogates without any table, and
  one value the same one everywhere (coreference), on every machine, each time.
* Cards and IBANs keep valid check digits, IBANs and phone numbers their country,
  addresses their range (private, public; the first group of an IPv6 address),
  e-mail domains their endings and reserved names.
* Names are replaced part by part, one map for all: a surname has one surrogate
  whatever title, given name or order it comes with. A given name (the first part of several) gets one
  of its gender and script from ``GIVEN``. A document's first full name that
  has a part decides whether that is a given name, and its gender; a lone part after a title is a surname.
  Particles (van, de), initials and titles stay. In scripts without
  spaces a part is found again only as a run of letters of its own.
* Collisions: given names are drawn from a list, so two names can meet, and a
  surrogate can equal another value of the corpus. Both are checked over
  all distinct values, by grouped aggregation; those that lose (all but the least)
  draw again until none collides; given names become double names (Anna-Vera), from draw ``WIDE`` on
  e-mails, surnames and secrets get more characters each time, and private addresses any private range. Only these exceptions
  are sent to the tasks, if they fit ``EXCEPTIONS`` (their counted number), or
  else joined to their documents. All others are replaced row-locally.

Values are compared lower-cased and without formatting where that does not
distinguish them, and surrogates take over the case and formatting of each place.

Output, one row for each input row: doc_id, text, n_entities, entities (kind,
start and end in the input's code points, surrogate). A null text stays null.
Ids may be null or repeated.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pick, pieces, ready, stage

EXCEPTIONS = 1_000_000
MAX_DRAWS = 24
SALT = 16
#: Draws from this one on are longer or of a wider range.
WIDE = 3
#: Characters that are permuted as one number.
BLOCK = 32

# Given names by script and gender, and the titles that show it.
GIVEN = {
    ("latin", "f"): "Alice Anna Bella Carla Clara Diana Elena Emma Eva Flora Greta Hanna Irene Julia Karin Laura Lena Lucia "
                    "Maria Marta Nadia Nina Olga Paula Petra Rosa Sara Sofia Tina Vera".split(),
    ("latin", "m"): "Adam Alan Albert Anton Boris Bruno Carl Daniel David Emil Erik Felix Frank Georg Hugo Ivan Jakob Jan "
                    "Julian Karl Leo Lukas Marco Martin Oscar Paul Peter Robert Simon Victor".split(),
    ("cyrillic", "f"): "Алла Анна Вера Галина Дарья Елена Зоя Инна Ирина Лариса Любовь Мария Надежда Нина Ольга Раиса".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Игорь Кирилл Лев Марк Олег Павел Пётр Роман Фёдор".split(),
}
TITLES = {"m": "Mr Mister Sir Lord Herr Herrn Señor Monsieur Signor Господин господин".split(),
          "f": "Mrs Ms Miss Lady Dame Frau Señora Señorita Madame Mademoiselle Signora Госпожа госпожа".split(),
          "n": "Dr Doctor Prof Professor".split()}
GENDER = {t: g for g, ts in TITLES.items() for t in ts}
#: Lower-case words inside names.
PARTICLES = "van von der den de del della di da dos du la le ten ter zu bin ibn al".split()
#: Country calling codes of one and of two digits; all others have three.
CODES_1 = "1 7".split()
CODES_2 = ("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
           "81 82 84 86 90 91 92 93 94 95 98").split()
#: Reserved e-mail domains and endings; they identify nobody.
RESERVED = {"example", "test", "invalid", "localhost"}

DIGITS = "0123456789"
GROUPS = [DIGITS, "bcdfghjklmnpqrstvwxz", "aeiouy", "áàâãäåæéèêëíìîïóòôõöøúùûüýÿœ", "çðñþß", "бвгджзйклмнпрстфхцчшщ", "аеёиоуыэюя",
          "αεηιουω", "βγδζθκλμνξπρσςτφχψ"]
CLASS_OF = {c: (g, i) for g in GROUPS for i, c in enumerate(g)}


@lru_cache(maxsize=100_000)
def class_of(c: str) -> tuple[str, int] | None:
    """A character's group and its place there: of ``GROUPS``, else the letters
    or digits of its kind among the 256 code points about it. None: it stays."""
    if c in CLASS_OF:
        return CLASS_OF[c]
    kind = unicodedata.category(c)
    if kind not in ("Lo", "Ll", "Nd"):
        return None
    block = ord(c) & ~255
    group = "".join(x for x in map(chr, range(block, block + 256)) if x not in CLASS_OF and unicodedata.category(x) == kind
                    and x == x.lower() and len(x.upper()) == 1 and x.upper().lower() == x)
    return (group, group.index(c)) if c in group else None


IBAN_CHARACTERS = {c: (g, i) for g in (DIGITS, "abcdefghijklmnopqrstuvwxyz") for i, c in enumerate(g)}
HEX = {c: ("0123456789abcdef", i) for i, c in enumerate("0123456789abcdef")}

NUMBER = re.compile(
    r"(?<![\d.])(?P<ip>(?:\d{1,3}\.){3}\d{1,3})(?!\.?\d)"
    r"|(?<![\d+-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\d-])"
    r"|(?<![\w+])(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?!\d)"
    r"|(?<![\d.-])(?P<card>\d(?:[ -]?\d){12,18})(?![\d])")
NATIONAL = re.compile(r"(?i)\b(?:tel|telephone|telefon|phone|fon|call|mobile|mobil|cell|fax)\b[.:]{0,2}[ \t]{0,3}"
                      r"(?P<phone>\(?0\d{1,5}\)?[ /-]\d{2,8}(?:[ /-]\d{2,6}){0,3})(?!\d)")
IP6 = re.compile(r"(?<![\w:.])(?=[0-9a-fA-F]{0,4}:)[0-9a-fA-F:]{4,39}(?![\w:]|\.\d)")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![A-Za-z0-9])")
SECRET = re.compile(r"(?i)\b(?:token|api[ _-]?key|access[ _-]?key|secret(?:[ _-]?key)?)[\"']?\s{0,4}[:=]\s{0,4}"
                    r"[\"']?(?P<secret>(?:[A-Za-z0-9_+/-]{16,}|(?=[A-Za-z_+/-]*\d)[A-Za-z0-9_+/-]{8,15}(?![A-Za-z0-9_+/-])))"
                    r"|\bbearer\s{1,4}(?P<bearer>[A-Za-z0-9._~+/-]{16,}=*)|\b(?P<aws>AKIA[0-9A-Z]{16})\b"
                    # what people type: any visible characters, quoted or up to a separator
                    r"|\b(?:password|passwd|pwd)[\"']?\s{0,4}[:=]\s{0,4}(?:\"(?P<quoted>[^\n\"]{6,})\"|'(?P<single>[^\n']{6,})'"
                    r"|(?P<password>[^\s\"'<>,;]{5,}[^\s\"'<>,;.:)\]}]))")
WORD = r"[^\W\d_]"
UPPER = r"(?=[^\W\d_a-zß-öø-ÿа-я])"
# whole runs of letters, joined by hyphens, or by apostrophes before a capital (not the s of a genitive)
TOKEN = rf"{UPPER}{WORD}++(?:(?:-(?={WORD})|['’]{UPPER}){WORD}++)*+"
INITIAL = rf"(?:{UPPER}{WORD}\. ?)"
PART = re.compile(rf"(?<!{WORD}){TOKEN}")
NAME = re.compile(rf"\b(?P<title>{'|'.join(sorted(GENDER, key=len, reverse=True))})\.? "
                  rf"(?P<name>{INITIAL}{{0,3}}(?:(?:{'|'.join(PARTICLES)}) ){{0,3}}{TOKEN}"
                  rf"(?: {INITIAL}{{0,3}}(?:(?:{'|'.join(PARTICLES)}) ){{0,3}}{TOKEN}){{0,3}}+)")
LOCAL, DOMAIN = re.compile(r"[\w.+-]"), re.compile(r"(?:[\w-]{1,63}\.){1,8}[^\W\d_]{2,24}")
HINT = re.compile("[0-9@]")
NAMED = re.compile("(?i)token|key|secret|passw|pwd|bearer|akia")
CALLED = re.compile("(?i)tel|fon|phone|call|mobil|cell|fax")
COLONS = re.compile("[0-9a-fA-F]:[0-9a-fA-F:]|::")


# ------------------------------------------------------------ detection

def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def issued(digits: str) -> bool:
    """Whether a number has an issuer's prefix and length."""
    n, two, four = len(digits), int(digits[:2]), int(digits[:4])
    return (digits[0] == "4" and n in (13, 16, 19) or n == 16 and (51 <= two <= 55 or 2221 <= four <= 2720 or four == 6011 or two == 65)
            or n == 15 and two in (34, 37))


def iban(value: str) -> bool:
    """Whether the check digits of an IBAN, without spaces, are right."""
    return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def address6(value: str) -> bool:
    """Whether a run is an IPv6 address: valid, and of three groups or a first one of four digits."""
    try:
        ipaddress.IPv6Address(value)
    except ValueError:
        return False
    groups = value.split(":")
    return len(groups[0]) == 4 or sum(map(bool, groups)) > 2


def country(phone: str) -> int:
    """The length of a number's + and country code."""
    return 0 if phone[0] != "+" else 2 if phone[1] in CODES_1 else 3 if phone[1:3] in CODES_2 else 4


def numbered(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all personal data but names, left to right."""
    found = []
    if HINT.search(text):
        at = text.find("@")
        while at >= 0:
            domain = DOMAIN.match(text, at + 1)
            if domain:
                start = at
                while start and LOCAL.match(text[start - 1]):
                    start -= 1
                while start < at and text[start] in ".+-":
                    start += 1
                if start < at:
                    found.append((start, domain.end(), "email"))
            at = text.find("@", at + 1)
        for m in NUMBER.finditer(text):
            kind, value = m.lastgroup, m[0]
            plain = re.sub(r"\D", "", value)
            if kind == "ip" and all(int(p) < 256 for p in value.split(".")) or kind == "ssn" \
                    or kind == "phone" and 8 <= len(plain) <= 15 or kind == "card" and issued(plain) and luhn(plain):
                found.append((m.start(), m.end(), kind))
        for m in IBAN.finditer(text):
            if iban(m[0].replace(" ", "")):
                found.append((*m.span(), "iban"))
        if COLONS.search(text):
            found += [(*m.span(), "ip6") for m in IP6.finditer(text) if address6(m[0])]
        if CALLED.search(text):
            found += [(*m.span("phone"), "phone") for m in NATIONAL.finditer(text)
                      if 6 <= sum(map(str.isdigit, m["phone"])) <= 15]
    elif "::" in text:
        found += [(*m.span(), "ip6") for m in IP6.finditer(text) if address6(m[0])]
    if NAMED.search(text):
        for m in SECRET.finditer(text):
            found.append((*m.span(m.lastgroup), "secret"))
    out: list[tuple[int, int, str]] = []
    for s in sorted(found, key=lambda s: (s[0], -s[1])):
        if not out or s[0] >= out[-1][1]:
            out.append(s)
    return out


def gender_of(given: str, gender: str) -> str:
    """The gender of a given name: its title's, else that of the list that has it."""
    if gender == "n":
        for (_, g), names in GIVEN.items():
            if given.capitalize() in names:
                return g
    return gender


def scan(text: str) -> tuple[list[tuple[int, int, str]], dict[str, str]]:
    """(start, end, kind) of the personal data in a text, left to right, and the
    kind (given_f, given_m, given_n, surname) of each name part, lower-cased."""
    plain = numbered(text)
    names = [(GENDER[m["title"]], [p for p in PART.finditer(m["name"]) if len(p[0]) > 1 and p[0] not in GENDER], m.start("name"))
             for m in NAME.finditer(text)]
    roles: dict[str, str] = {}
    titled = {}
    for gender, parts, at in names:
        if parts:
            titled[at + parts[0].start()] = gender
        if len(parts) > 1:
            given = parts[0][0].lower()
            roles.setdefault(given, "given_" + gender_of(given, gender))
            for p in parts[1:]:
                roles.setdefault(p[0].lower(), "surname")
    for _, parts, _ in names:
        for p in parts:
            roles.setdefault(p[0].lower(), "surname")
    if not roles:
        return plain, roles
    mentions: list[tuple[int, int, str]] = []
    k = 0
    for m in PART.finditer(text):
        role = roles.get(m[0].lower())
        if role is None or m[0] in GENDER:
            continue
        while k < len(plain) and plain[k][1] <= m.start():
            k += 1
        if k < len(plain) and plain[k][0] < m.end():
            continue                                     # inside an address or the like
        gender = titled.get(m.start(), role[-1] if role != "surname" else "n")
        if mentions and text[mentions[-1][1]:m.start()] == " " and m.start() not in titled:
            start, _, kind = mentions.pop()
            mentions.append((start, m.end(), kind if kind != "name_n" else "name_" + gender))
        else:
            mentions.append((m.start(), m.end(), "name_" + gender))
    return sorted(plain + mentions), roles


def detect(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the personal data in a text, left to right."""
    return scan(text)[0]


def distinct_values(text: str) -> set[tuple[str, str]]:
    """(kind, canonical value) of what needs a surrogate in a text; names by part."""
    spans, roles = scan(text)
    return {(k, canonical(k, text[s:e])) for s, e, k in spans if not k.startswith("name_")} | {(r, p) for p, r in roles.items()}


def canonical(kind: str, value: str) -> str:
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", value)
    if kind == "phone":
        return re.sub(r"[^\d+]", "", value)
    if kind == "iban":
        return value.replace(" ", "").lower()
    if kind == "ip6":
        return ipaddress.IPv6Address(value).exploded
    return value.lower()


# ------------------------------------------------------------ surrogates

class Forge:
    """Surrogates under a key."""

    def __init__(self, key: bytes):
        self.key = key

    def _draw(self, *parts) -> int:
        said = "\x1f".join(map(str, parts)).encode()
        return int.from_bytes(hmac.new(self.key, said, hashlib.sha256).digest()[:16], "little")

    def permute(self, digits: list[int], sizes: list[int], form: str) -> list[int]:
        """A keyed permutation of the numbers of a mixed-radix system: Feistel
        rounds that add to one half what the key draws for the other."""
        half = len(sizes) // 2
        space = [1, 1]
        value = [0, 0]
        for k, (d, s) in enumerate(zip(digits, sizes, strict=True)):
            side = k >= half
            space[side] *= s
            value[side] = value[side] * s + d
        for turn in range(10):
            side = turn % 2
            value[side] = (value[side] + self._draw(form, turn, value[1 - side])) % space[side]
        out = [0] * len(sizes)
        for k in range(len(sizes) - 1, -1, -1):
            side = k >= half
            value[side], out[k] = divmod(value[side], sizes[k])
        return out

    def characters(self, value: str, form: str, place=class_of, keep: str = "") -> str:
        """Permutes the letters and digits of a value within their groups."""
        at = [k for k, c in enumerate(value) if c not in keep and place(c)]
        if not at:
            return value
        out = list(value)
        # a draw has 128 bits: more characters go in blocks, so that all of them change
        blocks = -(-len(at) // BLOCK)
        for b in range(blocks):
            own = at[b * len(at) // blocks:(b + 1) * len(at) // blocks]
            groups = [place(value[k]) for k in own]
            inside = set(own)
            shape = form + (f"|{b}" if b else "") + "|" + "".join(
                value[k] if k not in inside else place(value[k])[0][0]
                for k in (range(own[0], own[-1] + 1) if blocks > 1 else range(len(value))))
            for k, (g, _), d in zip(own, groups, self.permute([i for _, i in groups], [len(g) for g, _ in groups], shape), strict=True):
                out[k] = g[d]
        return "".join(out)

    def surrogate(self, kind: str, value: str, draw: int = 0) -> str:
        """The surrogate of a canonical value; other draws for exceptions."""
        out = self._surrogate(kind, value, draw)
        if draw < WIDE or kind not in ("email", "secret", "surname"):
            return out
        local, at, domain = out.partition("@") if kind == "email" else (out, "", "")
        return local + self._more(kind, value, draw) + at + domain

    def _more(self, kind: str, value: str, draw: int) -> str:
        """Further characters of a value's own kind, one more with each draw."""
        if kind == "secret" and re.fullmatch("[0-9a-f]+", value):
            pool = "0123456789abcdef"
        else:
            letters = [c for c in value.partition("@")[0] if c.isalpha() and class_of(c)]
            pool = class_of(letters[-1])[0] if letters else GROUPS[1]
        n, out = self._draw("more", kind, value, draw), ""
        for _ in range(draw - WIDE + 1):
            n, k = divmod(n, len(pool))
            out += pool[k]
        return out

    def _surrogate(self, kind: str, value: str, draw: int) -> str:
        form = kind if not draw else f"{kind}#{draw}"
        if kind == "email":
            local, domain = value.split("@", 1)
            labels = domain.split(".")
            own = [x if k == len(labels) - 1 or x in RESERVED else self.characters(x, "domain") for k, x in enumerate(labels)]
            return self.characters(local, form + "@" + domain) + "@" + ".".join(own)
        if kind == "card":
            head = {"4": 1, "3": 2, "5": 2}.get(value[0], 4)        # what shows the issuer
            body = value[:head] + self.characters(value[head:-1], form + value[:head])
            return next(body + c for c in DIGITS if luhn(body + c))
        if kind == "ip":
            n, a = 0, [int(p) for p in value.split(".")]
            for p in a:
                n = n << 8 | p
            while True:                                  # walk on until the range is the same
                n = self.permute([n >> 16, n & 0xFFFF], [1 << 16, 1 << 16], form)
                n = n[0] << 16 | n[1]
                out = ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
                same = (ip_range(out), ip_range(".".join(map(str, a))))
                if same[0] == same[1] or draw >= WIDE and all(r.startswith("private") for r in same):
                    return out
        if kind == "phone":
            # the fictional exchange and the country stay, while that leaves enough numbers
            if re.fullmatch(r"\+1\d{3}555\d{4}", value) and not draw:
                inner = self.characters(value[2:5] + value[8:], form)
                return value[:5][:2] + inner[:3] + "555" + inner[3:]
            head = country(value) or (1 if value[0] == "0" else 0)
            return value[:head] + self.characters(value[head:], form)
        if kind == "secret":
            table = HEX.get if re.fullmatch("[0-9a-f]+", value) else class_of
            return value[:4] + self.characters(value[4:], form) if value.startswith("akia") else self.characters(value, form, table)
        if kind == "iban":
            body = value[:2] + self.characters(value[4:], form + value[:2], IBAN_CHARACTERS.get)
            rest = int("".join(str(int(c, 36)) for c in body[2:] + body[:2] + "00")) % 97
            return f"{body[:2]}{98 - rest:02d}{body[2:]}"
        if kind == "ip6":
            return value[:4] + self.characters(value[4:], form + value[:4], HEX.get, keep=":")
        if kind.startswith("given_"):
            script = next((s for s in ("latin", "cyrillic") if s.upper() in unicodedata.name(value[0], "")), None)
            if script is None:
                return self.characters(value, "surname" + form[7:])
            names = [n for g in ("f", "m") if kind[-1] in (g, "n") for n in GIVEN[script, g]]
            n, out = self._draw(form, value), []
            for _ in range(draw + 1):                    # double names, the more the later the draw
                n, k = divmod(n, len(names))
                out.append(names[k].lower())
            return "-".join(out)
        if kind.startswith("name_"):                     # a whole name: its parts
            first, *rest = value.split(" ")
            roles = ["given" + kind[4:]] + ["surname"] * len(rest) if rest else ["surname"]
            return " ".join(self.surrogate(r, p, draw) for r, p in zip(roles, [first, *rest], strict=True))
        return self.characters(value, form)

    def restyle(self, kind: str, original: str, surrogate: str) -> str:
        """The surrogate in the case and formatting of a place."""
        if kind == "iban":
            kept = iter(surrogate.upper())
            return "".join(next(kept) if c != " " else c for c in original)
        if kind == "ip6":
            short = ipaddress.IPv6Address(surrogate).compressed
            return short.upper() if original.isupper() else short
        if kind in ("card", "ssn", "phone"):
            kept = iter(c for c in surrogate if c.isdigit())
            return "".join(next(kept) if c.isdigit() else c for c in original)
        if kind.startswith(("given_", "name_")) or kind == "surname" and len(surrogate) != len(original):
            return surrogate.upper() if original.isupper() else re.sub(r"[^\W\d_]+", lambda m: m[0].capitalize(), surrogate)
        if len(surrogate) == len(original):
            return "".join(s.upper() if o.isupper() else s for o, s in zip(original, surrogate, strict=True))
        return surrogate

    def name(self, text: str, roles: dict[str, str], own: dict) -> str:
        """A mention of a name with the surrogates of its parts."""
        def part(m):
            low = m[0].lower()
            role = roles.get(low)
            if role is None:
                return m[0]
            return self.restyle(role, m[0], own.get((role, low)) or self.surrogate(role, low))
        return PART.sub(part, text)


def ip_range(ip: str) -> str:
    a, b, *_ = (int(p) for p in ip.split("."))
    if a == 10 or a == 192 and b == 168 or a == 172 and 16 <= b < 32:
        return f"private{a}"
    return "other" if a in (0, 127) or a >= 224 or a == 169 and b == 254 else "public"


# ------------------------------------------------------------ jobs

def _values(batches):
    for b in pieces(batches):
        met = set()
        for text in b.column("text").to_pylist():
            met |= distinct_values(text or "")
        met = sorted(met)
        yield pa.RecordBatch.from_pydict({"kind": pa.array([k for k, _ in met], pa.string()),
                                          "value": pa.array([v for _, v in met], pa.string())})


def _drawn(forge: Forge, draw: int):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"kind": b.column("kind"), "value": b.column("value"), "surrogate": pa.array(
                [forge.surrogate(k, v, draw) for k, v in zip(b.column("kind").to_pylist(), b.column("value").to_pylist(), strict=True)],
                pa.string())})
    return run


SURROGATES = "kind string, value string, surrogate string"


def _space(kind: str = "kind"):
    """All parts of names share one space of values."""
    return F.regexp_replace(kind, "^(name_.*|given_.*|surname)$", "name")


def settled(values: DataFrame, forge: Forge) -> DataFrame:
    """(kind, value, surrogate, draw) of distinct values: no surrogate twice in a
    kind, none that is another value of the corpus."""
    done, left = None, values
    for draw in range(MAX_DRAWS):
        new = stage(left.mapInArrow(_drawn(forge, draw), SURROGATES), "surrogates")
        taken = new.select(_space().alias("space"), "surrogate", "kind", "value", F.lit(1).alias("now"))
        if done is not None:
            taken = taken.unionByName(done.select(_space().alias("space"), "surrogate", "kind", "value", F.lit(0).alias("now")))
        # the first of each surrogate has it: an earlier draw's, else the least value
        first = taken.groupBy("space", "surrogate").agg(F.min(F.struct("now", "value", "kind")).alias("f"))
        real = values.select(_space().alias("space"), F.col("value").alias("surrogate")).distinct()
        free = (first.filter("f.now = 1").join(real, ["space", "surrogate"], "left_anti")
                .select("f.kind", "f.value", F.lit(draw).alias("draw")))
        ok = stage(new.join(free, ["kind", "value"]), "surrogates")
        done = ok if done is None else done.unionByName(ok)
        left = stage(new.join(ok.select("kind", "value"), ["kind", "value"], "left_anti").select("kind", "value"), "values")
        if not left.limit(1).count():
            return done
    raise RuntimeError("surrogates still collide; the forms of the values leave too little room")


def _replace(forge: Forge, sent):
    """Rewrites texts; ``sent``: a broadcast of the exceptions, or None if each
    row brings its own."""
    def run(batches):
        for b in pieces(batches):
            texts, entities = [], []
            extra = b.column("own").to_pylist() if sent is None else None
            for row, text in enumerate(b.column("text").to_pylist()):
                own = {(e["kind"], e["value"]): e["surrogate"] for e in extra[row] or []} if sent is None else sent.value
                out, spans, at = [], [], 0
                found, roles = scan(text or "")
                for start, end, kind in found:
                    if kind.startswith("name_"):
                        new = forge.name(text[start:end], roles, own)
                    else:
                        value = canonical(kind, text[start:end])
                        new = own.get((kind, value)) or forge.surrogate(kind, value)
                        new = forge.restyle(kind, text[start:end], new)
                    out += [text[at:start], new]
                    spans.append({"kind": kind, "start": start, "end": end, "surrogate": new})
                    at = end
                texts.append(text if text is None or not spans else "".join(out) + text[at:])
                entities.append(spans)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "text": pa.array(texts, pa.string()),
                "n_entities": pa.array([len(e) for e in entities], pa.int64()),
                "entities": pa.array(entities, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                                                   ("end", pa.int32()), ("surrogate", pa.string())])))})
    return run


OUT = ("doc_id long, text string, n_entities long, "
       "entities array<struct<kind:string,start:int,end:int,surrogate:string>>")


def _spans(batches):
    for b in pieces(batches):
        doc, mark, kinds, values = [], [], [], []
        for d, m, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "mark", "text")), strict=True):
            for kind, value in sorted(distinct_values(text or "")):
                doc.append(d)
                mark.append(m)
                kinds.append(kind)
                values.append(value)
        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(doc, pa.int64()), "mark": pa.array(mark, pa.int64()),
                                          "kind": pa.array(kinds, pa.string()), "value": pa.array(values, pa.string())})


def replace_pii(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text",
                exceptions: int = EXCEPTIONS) -> DataFrame:
    """Documents with surrogates (see the module's docstring)."""
    if not key:
        raise ValueError("a key is needed")
    spark, forge = ready(docs.sparkSession), Forge(key)
    texts = pick(docs, doc_id=F.col(f"`{id_col}`").cast("long"), text=F.col(f"`{text_col}`").cast("string"))
    values = stage(texts.select("text").mapInArrow(_values, "kind string, value string").distinct(), "pii-values")
    odd = stage(settled(values, forge).filter("draw > 0").select("kind", "value", "surrogate"), "pii-exceptions")
    if odd.count() <= exceptions:
        sent = spark.sparkContext.broadcast({(r["kind"], r["value"]): r["surrogate"] for r in odd.collect()})
        return texts.mapInArrow(_replace(forge, sent), OUT)
    marked = texts.withColumn("mark", F.xxhash64("text"))
    spans = (marked.mapInArrow(_spans, "doc_id long, mark long, kind string, value string")
             .withColumn("salt", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(SALT)).cast("int")))
    salted = odd.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    own = (spans.join(salted, ["kind", "value", "salt"]).groupBy(F.col("doc_id").alias("_d"), F.col("mark").alias("_m"))
           .agg(F.collect_set(F.struct("kind", "value", "surrogate")).alias("own")))
    joined = marked.join(own, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m")), "left")
    return joined.select("doc_id", "text", "own").mapInArrow(_replace(forge, None), OUT)
