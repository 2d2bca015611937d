"""Personal data: patterns, and a chain over word shapes for what has no pattern.

Base spans (e-mail addresses, IP addresses, card and phone numbers) come
from patterns with checks. A linear-chain conditional random field over
word-shape features, trained from the small labelled table below (made
values of many formats in sentences of several languages), adds
``secret`` spans (keys, tokens, passwords), which only their look and
their context give away; a span is the whole value, up to a blank, a
quote or a bracket. Decoding is Viterbi in numpy batches: a word
whose best label can't change whatever its neighbours are splits the
chain there, so only short uncertain stretches are decoded, exactly.

Defined cases
-------------
* Null or empty text: no spans.
* Spans count code points, the end is exclusive. Spans of one kind don't
  overlap; an added span that touches a base span's text is dropped.
* Equal starts: in the order of ``KINDS``.
* Rows are independent: repeated rows get equal results; other columns
  are carried in ``row``.

Scale: a map over the scan, no shuffle; only the model's few hundred
weights are shipped. Each pattern takes time linear in the text.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from . import textkit as T
from .rows import name

KINDS = ("email", "ip", "card", "phone", "secret")
LABELS = ("other", "cue", "secret")

# ---------------------------------------------------------------- patterns

#: From the "@" on; the part before it is read backwards, so no run is scanned twice.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match can only begin where a run of digits does.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str):
    free = 0  # end of the last match
    for m in DOMAIN.finditer(text):
        at = start = m.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            free = m.end()
            yield start, free


def ips(text: str):
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def cards(text: str):
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str):
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def base_spans(text: str, has_at: bool = True, has_digit: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the pattern kinds."""
    out = [(a, 0, b) for a, b in emails(text)] if has_at else []
    if has_digit:
        out += [(a, 1, b) for a, b in ips(text)]
        out += [(a, 2, b) for a, b in cards(text)]
        out += [(a, 3, b) for a, b in phones(text)] if "+" in text else []
    return sorted(out)


# ------------------------------------------------------------ word shapes

def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(chars)] = True
    return t


_DIGITS, _UPPER, _LOWER = bytes(range(0x30, 0x3A)), bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
DIGIT, UPPER, LOWER = _table(_DIGITS), _table(_UPPER), _table(_LOWER)
HEX = _table(_DIGITS + b"abcdefABCDEF")
WIDE = _table(bytes(range(0x80, 0x100)))
JOINT = _table(b"-_./+%")
SIGN = _table(b"=:")
QUOTE = _table(b"\"'`")
WORD = DIGIT | UPPER | LOWER | WIDE | JOINT | _table(b"@")
#: Words that announce a secret, alone or as the last part of a name (DB_PASSWORD, client-secret).
CUES = ("token", "key", "secret", "password", "passwd", "pass", "pwd", "passphrase", "apikey", "auth", "bearer", "credential",
        "credentials", "pin", "schlüssel", "passwort", "kennwort", "clave", "contraseña", "clé", "jeton", "heslo", "klíč",
        "chiave", "senha")


#: Words that announce a string that is no secret.
HARMLESS = ("commit", "sha", "sha1", "sha256", "md5", "hash", "checksum", "digest", "etag", "uuid", "guid", "id", "blob", "build",
            "tag", "version", "order", "invoice", "ticket", "isbn", "flight", "part", "number", "nr", "no", "page", "line",
            "fingerprint", "revision", "session", "prüfsumme", "numéro", "número")


def _hash_words(items) -> np.ndarray:
    buf, off = T.text_bytes(pa.array(list(items)))
    return T.word_hashes(buf, off[:-1], off[1:])


_CUE_HASHES, _HARMLESS_HASHES = _hash_words(CUES), _hash_words(HARMLESS)
#: Features, as bits of a word's shape; the places of two of them.
N_BITS, CUE_BIT, SIGN_BIT = 22, 16, 17


def shapes(buf: np.ndarray, off: np.ndarray):
    """Starts and ends of the tokens of a batch, token offsets of its rows, and the shape bits of each token.

    A token is a run of word bytes or a run of "=" and ":".
    """
    kind = WORD[buf].astype(np.int8) + 2 * SIGN[buf].astype(np.int8)
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[off] = True
    new = np.concatenate([[True], kind[1:] != kind[:-1]]) | edge[:-1] if len(buf) else np.zeros(0, bool)
    bounds = np.flatnonzero(new)
    ends = np.concatenate([bounds[1:], [len(buf)]]) if len(bounds) else bounds
    token = kind[bounds] > 0 if len(bounds) else np.zeros(0, bool)
    starts, ends = bounds[token], ends[token]
    size = ends - starts

    def count(table):
        acc = np.zeros(len(buf) + 1, dtype=np.int32)
        np.cumsum(table[buf], out=acc[1:])
        return acc[ends] - acc[starts]

    digits, upper, lower, wide = count(DIGIT), count(UPPER), count(LOWER), count(WIDE)
    letters = upper + lower + wide
    quoted = np.zeros(len(starts), dtype=bool)
    inside = starts > 0
    quoted[inside] = QUOTE[buf[starts[inside] - 1]]
    # The last part of a token: from behind its last joint on.
    joint = np.where(JOINT[buf], np.arange(1, len(buf) + 1), 0) if len(buf) else np.zeros(0, np.int64)
    behind = np.maximum.accumulate(joint)[ends - 1] if len(starts) else starts
    last = np.where((behind > starts) & (behind < ends), behind, starts)
    last_part = T.word_hashes(T.lower_ascii(buf), last, ends)
    cue = np.isin(last_part, _CUE_HASHES)
    mixed = (digits > 0) & (letters > 0)
    bits = (np.ones(len(starts), bool), size <= 3, (size > 3) & (size <= 7), (size > 7) & (size <= 15),
            (size > 15) & (size <= 31), size > 31, digits > 0, (digits == size), lower > 0, upper > 0,
            mixed & (count(HEX) == size), mixed & (digits >= 3) & (letters >= 3), count(_table(b"@")) > 0,
            count(JOINT) > 0, wide > 0, quoted, cue, kind[starts] > 1 if len(starts) else np.zeros(0, bool),
            (letters == size) & (size <= 15), mixed & (upper > 0) & (lower > 0), np.isin(last_part, _HARMLESS_HASHES), (count(_table(b"/")) > 1) & (upper == 0))
    shape = np.zeros(len(starts), dtype=np.int64)
    for i, b in enumerate(bits):
        shape |= b.astype(np.int64) << i
    return starts, ends, np.searchsorted(starts, off), shape


def features(shape: np.ndarray) -> np.ndarray:
    return ((shape[:, None] >> np.arange(N_BITS)) & 1).astype(float)


# --------------------------------------------------------- labelled table

def _made(n: int, letters: str, seed: str) -> str:
    """A random-looking string of ``n`` of ``letters``, the same each time."""
    raw = b"".join(hashlib.sha256(f"{seed}{i}".encode()).digest() for i in range(n // 32 + 1))
    return "".join(letters[b % len(letters)] for b in raw[:n])


_HEX = "0123456789abcdef"
_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
_BASE64 = _ALNUM + "+/"
_PASS = _ALNUM + "-_%./"
ALPHABETS = {"h": _HEX, "a": _ALNUM, "b": _BASE64, "p": _PASS, "u": _ALNUM[:26] + _ALNUM[52:], "l": _ALNUM[26:],
             "d": _HEX[:10]}
#: Values of secrets: fixed text and {letters and length} of made strings.
VALUES = ("{h32}", "{h40}", "{h64}", "{a20}", "{a32}", "{a40}", "{b44}", "{b86}", "{p12}", "{p16}", "{l8}7", "{a10}", "{a14}",
          "AKIA{u16}", "ghp_{a36}", "sk_live_{a24}", "eyJ{a17}.eyJ{a40}.{a43}", "{h8}-{h4}-{h4}-{h4}-{h12}", "{u5}-{u5}-{u5}-{u5}",
          "glpat-{a20}", "ssh-rsa-{b40}", "{a6}_{a6}_{a12}", "{u1}{l4}4{l3}", "{u1}{l2}0{l3}3{l2}&1", "{l6}99", "{l4}-{l5}-{l4}-42", "{l3}7{l2}8{l1}!", "{l5}-{l6}-31", "{u1}{l6}2019")
#: Sentences around a value (*), in several languages and file formats.
CONTEXTS = (
    "API_KEY=*", 'api_key: "*"', "export SECRET='*'", "set DB_PASSWORD=* before you run it", 'password: "*" for the host',
    "his password is * since May", "secret = *", "Authorization: Bearer * was sent", 'key="*"', "use api-key * here",
    "auth = *. The end", "pwd=* user=guest", '{"client_secret": "*", "id": 7}', "access_key: * region: eu",
    "login with passphrase * please", "my password: *", "FTP_PASS=*", "the user's secret is *", "key *", "password * works", "<password>*</password>", "the new key is *", "PIN and key: *",
    "le mot de passe et la clé * ici", "le serveur lit le jeton = * ce soir", "la clave es * por ahora", "contraseña: * del sitio",
    "das Passwort: * gilt weiter", "der Schlüssel lautet *", "Kennwort = '*'", "heslo je *", "klíč: *", "la chiave * del server",
    "a senha é *", "token: * # rotate", "aws_secret_access_key = *", "--auth-token * --verbose", "credentials: me / *",
)
#: Sentences without a secret; the made strings in them are none.
CLEAN = (
    "The key to the house is under the mat.", "a mark of respect for the two of them", "No secret is safe for long.",
    "the password is wrong again", "Key figures: 12 of 40, up 3 percent", "Call +1 (212) 555-0143 after nine.",
    "write to anna.smith@mail.example.com or to 10.20.30.40", "the card 4929 3483 8514 6306 expired in 2019",
    "see https://www.example.com/en/index for more", "On 2024-01-31 at 10:45 it rained.", "invoice 20240131-{h4} of May",
    "Donaudampfschifffahrtsgesellschaft und Rechtsschutzversicherungen", "internationalization and characteristically long words",
    "Entre tanto, el clima cambia: llueve.", "Nous avons parlé; il est parti à 18 h.", "Er sagte: nichts ist verloren.",
    "commit {h40} fixes it", "merged in {h7} and {h40}", "sha256: {h64} of the file", "md5 {h32}  image.iso", "build {h12} passed",
    "etag {h32}, 200 OK", "order {h8}-{h4}-{h4}-{h4}-{h12} was shipped", "session {h32} closed", "blob {a20} stored",
    "Licensed under the Apache License, Version 2.0.", "ISBN 978-3-16-148410-0 and part B12-77", "MP3 and H264 are formats, v1.2.3 too",
    "and 1234567 times 89 equals x", "reference = next chapter", "total: 5000 units of type A4", "flight LH1234 at gate B22",
    "one | two | three | 4 | five", "WAIT!! *** 50%% OFF ### NOW &&& HERE", "id: {a11} title: a film", "watch?v={a11} again",
    "Das Passwort ist falsch.", "Kennwort vergessen?", "La clave del problema es simple.", "la clé de la porte", "un jeton de présence",
    "heslo je špatné", "la chiave di casa", "a senha expirou ontem", "the token ring network", "public key cryptography",
    "press any key to go on", "a key: the first of 3 notes", "auth: none", "password policy: 12 characters", "primary key (id)",
    "the number {d16} on the slip", "{d16} and then {d14}, twice", "SERIAL!! {d16}!! OF!! MANY", "part {d12}. Next", "{d15} Stück",
    "numéro {d16}, page 3", "keyword1 and keyword2", "open /var/log/app-2/error.log now", "src/main/java/App2.java was changed", "photos/2019/img_1234.jpg", "model X200 of 2021", "room 12b, floor 3", "COVID-19 in 2020", "4417123456789113 is a card",
)
#: Ordinary prose, several sentences each.
PROSE = (
    "In spring the river rises. Children go to school again, and the old mill is at work. Nobody knows why.",
    "She wrote a letter. It was a long one, of four pages. Afterwards she went out to see the harbour.",
    "The committee met on Monday. Unfortunately, no decision was taken. A new date is to be set by the end of June.",
    "Im Frühling steigt der Fluss. Kinder gehen wieder zur Schule, und die alte Mühle läuft. Niemand weiß, warum.",
    "Er schrieb einen Brief. Danach ging er hinaus. Übrigens war es ein schöner Tag, so wie am Sonntag zuvor.",
    "Die Sitzung begann um 9 Uhr. Entscheidungen fielen keine. Nächste Woche geht es in Köln weiter.",
    "Au printemps la rivière monte. Les enfants vont à l'école. Personne ne sait pourquoi, dit-on.",
    "Elle écrivit une lettre. Ensuite elle sortit voir le port. C'était un beau jour de mai, à Marseille.",
    "La réunion a commencé à 9 heures. Malheureusement, rien n'a été décidé. Une autre date est prévue.",
    "En primavera el río sube. Los niños van a la escuela. Nadie sabe por qué, según dicen.",
    "Ella escribió una carta. Después salió a ver el puerto. Era un día de mayo en la ciudad.",
    "La reunión empezó a las 9. Lamentablemente, no hubo acuerdo. Habrá otra fecha en junio o julio.",
    "Na jaře řeka stoupá. Děti jdou do školy. Nikdo neví proč.", "In primavera il fiume sale. Nessuno sa perché. Andiamo.",
    "LOOK HERE!! A GREAT OFFER!! ONLY NOW!! 100%% OF THE BEST THINGS!!", "Buy now, or never. WOW!!! It's 50 %% off ###",
    "Thatcherism and Keynesianism. Antidisestablishmentarianism, of all things. Zusammengehörigkeitsgefühl.",
)
#: Contexts that each value is put into.
EACH = 5


def labelled() -> list[str]:
    """The labelled sentences: {letters and length} are made strings, those between the marks < and > are secrets."""
    out = []
    for n, value in enumerate(VALUES):
        for k in range(EACH):
            out.append(CONTEXTS[(n * EACH + 7 * k) % len(CONTEXTS)].replace("*", f"\x01{value}\x02"))
    return out + list(CLEAN) * 2 + list(PROSE) * 3


def training_set():
    """Token shapes, labels, starts and lengths of the labelled sentences."""
    texts, secrets = [], []
    for n, line in enumerate(labelled()):
        text, marks = "", []
        for part in re.split(r"(\{[a-z]\d+\}|[\x01\x02])", line):
            if part == "\x01":
                marks.append([len(text.encode()), 0])
            elif part == "\x02":
                marks[-1][1] = len(text.encode())
            elif re.fullmatch(r"\{[a-z]\d+\}", part):
                text += _made(int(part[2:-1]), ALPHABETS[part[1]], f"{n}.{len(text)}")
            else:
                text += part
        texts.append(text)
        secrets.append(marks)
    buf, off = T.text_bytes(pa.array(texts))
    starts, ends, rows, shape = shapes(buf, off)
    y = np.zeros(len(starts), dtype=np.int64)
    for r, marks in enumerate(secrets):
        for i in range(rows[r], rows[r + 1]):
            a = starts[i] - off[r]
            if any(m <= a < e for m, e in marks):
                y[i] = 2
            elif marks and a < marks[-1][0] and shape[i] >> CUE_BIT & 1:
                y[i] = 1
            elif i > rows[r] and y[i - 1] == 1 and shape[i] >> SIGN_BIT & 1:
                y[i] = 1  # the sign after a cue hands it on
    return features(shape), y, rows[:-1], np.diff(rows)


def fit() -> tuple[np.ndarray, np.ndarray]:
    """Weights [3 * bits, labels] and moves, from the labelled table."""
    x, y, starts, lengths = training_set()
    return crf.train(crf.with_neighbours(x, starts, lengths), y, starts, lengths, len(LABELS), penalty=0.3)


# ------------------------------------------------------------------ decode

def decode(shape: np.ndarray, rows: np.ndarray, model) -> np.ndarray:
    """Best label of every token; ``rows`` are the token offsets of the texts."""
    weights, move = model
    n = len(shape)
    if not n:
        return np.zeros(0, dtype=np.int64)
    kinds, at = np.unique(shape, return_inverse=True)
    f = features(kinds)
    own, before, after = (f @ w for w in np.split(weights, 3))
    score = own[at]
    cut = np.zeros(n + 1, dtype=bool)
    cut[rows] = True
    inner = np.flatnonzero(~cut[:n])  # tokens with one before them in their text
    score[inner] += before[at[inner - 1]]
    score[inner - 1] += after[at[inner]]
    # "other" is certain where no neighbours could make up for its lead.
    gain = np.maximum(0, (move - move[:, :1]).max(0)) + np.maximum(0, (move - move[:1]).max(1))
    sure = (score[:, :1] - score[:, 1:] > gain[1:]).all(1)
    label = np.zeros(n, dtype=np.int64)
    open_ = ~sure
    begin = np.flatnonzero(open_ & (np.concatenate([[True], sure[:-1]]) | cut[:n]))
    end = np.flatnonzero(open_ & (np.concatenate([sure[1:], [True]]) | cut[1:])) + 1
    # The stretch starts after, and ends before, a certain "other", unless its text does.
    has_left, has_right = ~cut[begin], ~cut[end]
    score[begin[has_left]] += move[0]
    score[end[has_right] - 1] += move[:, 0]
    if len(begin):
        use = np.flatnonzero(open_)
        lengths = end - begin
        label[use] = crf.viterbi(score[use], move, np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return label


#: What ends a value: blanks, quotes and brackets. What isn't part of it at its ends.
STOP = _table(b" \t\n\x0b\x0c\r\"'`<>(){}[]|")
LOOSE = _table(b".,;:!?")


def _whole(raw: bytes, a: int, b: int) -> tuple[int, int]:
    """A secret's span, drawn out to the whole value it is part of: up to a blank or a quote, from a sign on."""
    while b < len(raw) and not STOP[raw[b]]:
        b += 1
    while a > 0 and not STOP[raw[a - 1]] and not SIGN[raw[a - 1]]:
        a -= 1
    while b > a and LOOSE[raw[b - 1]]:
        b -= 1
    while a < b and LOOSE[raw[a]]:
        a += 1
    return a, b


def spans_of(text, model) -> list[list[tuple[int, int, int]]]:
    """Per text: sorted (start, kind's place, end)."""
    buf, off = T.text_bytes(text)
    data = buf.tobytes()
    starts, ends, rows, shape = shapes(buf, off)
    secret = np.flatnonzero(decode(shape, rows, model) == 2)
    of_row: dict[int, list[int]] = {}
    for i, r in zip(secret.tolist(), (np.searchsorted(rows, secret, side="right") - 1).tolist()):
        of_row.setdefault(r, []).append(i)
    has_at = np.diff(np.searchsorted(np.flatnonzero(buf == 0x40), off)) > 0
    has_digit = np.diff(np.searchsorted(np.flatnonzero(DIGIT[buf]), off)) > 0
    out = []
    for r in range(len(off) - 1):
        if not (has_at[r] or has_digit[r] or r in of_row):
            out.append([])
            continue
        raw = data[off[r]:off[r + 1]]
        found = base_spans(raw.decode("utf-8", "replace"), bool(has_at[r]), bool(has_digit[r]))
        taken = list(found)
        for i in of_row.get(r, ()):
            a, b = _whole(raw, int(starts[i] - off[r]), int(ends[i] - off[r]))
            a, b = (len(raw[:x].decode("utf-8", "replace")) for x in (a, b))
            # Several tokens of one value give one span.
            if a < b and not any(a < e and s < b for s, _, e in taken):
                found.append((a, 4, b))
                taken.append((a, 4, b))
        out.append(sorted(found))
    return out


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` and ``spans``: kind, start, stop of everything found, in order."""
    docs = docs.select(F.struct(*[F.col(name(c)) for c in docs.columns]).alias("row"))
    model = fit()
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])

    def run(batches):
        for part, text in T.pieces(batches, text_col):
            spans = [[{"kind": KINDS[k], "start": a, "stop": b} for a, k, b in s] for s in spans_of(text, model)]
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(spans, type=pa.list_(kind))],
                                             names=["row", "spans"])

    return docs.mapInArrow(run, T.row_schema(docs, "spans array<struct<kind:string,start:int,stop:int>>"))


def query(spark, sf_dir: str) -> DataFrame:
    out = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    spans = F.col("spans")

    def listed(s):
        return F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")

    def number(kind):
        return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda x: x["kind"] != KINDS[4])
    return out.select("row.doc_id", *map(number, KINDS[:4]), F.sha2(listed(base), 256).alias("base_sha256"),
                      listed(spans).alias("spans"))
