"""Secret scan: fixed patterns, and sliding-window entropy, in DataFrame
expressions only.

The base patterns find assignments of secrets, access keys and long hex
strings.  A pattern's spans come from splitting the text at its matches: the
lengths of what lies between and of the matches add up to the places.

The method adds spans: a candidate string (a run of key characters with letters
and digits) is read by each character class (``ENTROPY_KINDS``) in windows of
``window`` characters.  The entropy of a window is log2(n) - S / n, with S the
sum of c * log2(c) over its character counts c.  Moving the window changes two
counts, so both the counts and S are updated and never counted anew.  The counts
of a window are packed into a few long numbers (``COUNT_BITS`` each).  Windows at
or over the class's threshold mark their characters; what they mark together is
one span.  Matches of the allow-list (placeholders, alphabets, long repeats) cut a
candidate: no window that comes within ``NEAR`` characters of one is marked, and
those further away are read as usual.  Base spans are never suppressed.

Only rows that hold a match or a candidate do any of this work, and all of it
stays inside the row: no shuffle.  Long lists are dealt into shorter ones and put
together again, so that a text of one long candidate takes time in proportion to
its length, and one of m matches m for the patterns and m ** 1.5 copied
references for their places.

Defined results: a null text counts as empty; texts without a match give zero
counts and empty lists; equal spans of two kinds are both listed; rows with
equal texts give equal results; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import let, text_or_empty

#: The patterns of the contract.  The bounds of "access" and
#: "hex" are in the pattern, which equals a check after: their matches are
#: whole runs.  "assign" is checked after, as a failing match still takes its text.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_CHARS = 8

#: Runs of key characters; a candidate has a digit and a letter.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Character class of a candidate: its pattern, its alphabet, and the least
#: entropy in bits of a window (of log2(20) = 4.32 at most).
ENTROPY_KINDS = (
    ("enthex", r"[0-9a-fA-F]+", "0123456789abcdefABCDEF", 3.0),
    ("entkey", r"[A-Za-z0-9+/_=-]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.9),
)
#: What keeps the candidate around it from being a secret.
ALLOWED = r"(?i)example|placeholder|your[_-]?(?:key|token|secret)|changeme|xxxx+|0123456789|abcdefghij|(.)\1{7,}"
#: Characters between a window and a match of the allow-list at least.
NEAR = 20
#: Bits of a count in a packed number, and counts in one.
COUNT_BITS, PACKED = 5, 12
#: Window ends that are read in one go.
STRETCH = 1024


def places(text: Column, pattern: str) -> Column:
    """(m, start, end) of every match, leftmost and not overlapping."""
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    span = "array<struct<m:string,start:int,end:int>>"

    def run_on(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            x["m"].alias("m"), start.alias("start"), end.alias("end")))).alias("out"))

    def shifted(lists: Column) -> Column:
        begins = F.aggregate(lists, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                             lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"),
                                                     F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]
        return let(begins, lambda by: F.flatten(F.transform(lists, lambda x, k: F.transform(x["out"], lambda y: F.struct(
            y["m"].alias("m"), (y["start"] + F.get(by, k)).alias("start"), (y["end"] + F.get(by, k)).alias("end"))))))

    def listed(all_: Column) -> Column:
        # lists of as many matches as there are lists
        few = F.ceil(F.sqrt(F.size(all_))).cast("int")
        return let(few, lambda c: F.when(c == 0, F.array().cast(span)).otherwise(let(F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / F.greatest(c, F.lit(1))).cast("int")), lambda k: F.aggregate(
                F.slice(all_, k * c + 1, c), F.struct(F.lit(0).alias("at"), F.array().cast(span).alias("out")), run_on)), shifted)))

    # parts[k] lies before match k, so a match begins after the parts up to its own
    # and the matches before it
    return let(F.struct(F.transform(parts, lambda p: F.length(p)).alias("p"), found.alias("f")), lambda s: let(
        F.transform(s["f"], lambda m, k: F.struct(m.alias("m"), F.get(s["p"], k).alias("gap"))), listed))


def _spans(kind: str, order: int, found: Column) -> Column:
    return F.transform(found, lambda x: F.struct(
        x["start"].alias("start"), F.lit(order).alias("order"), x["end"].alias("end"), F.lit(kind).alias("kind")))


def _none() -> Column:
    return F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")


def base_spans(text: Column) -> list[Column]:
    """One array of spans per base kind."""
    good = F.filter(places(text, ASSIGN.replace("([A-Za", "(?:[A-Za")), lambda x: F.length(
        F.regexp_extract(x["m"], ASSIGN, 1)) >= ASSIGN_CHARS)
    return [F.when(F.regexp_like(text, F.lit(p)), _spans(kind, k, found)).otherwise(_none())
            for k, (kind, p, found) in enumerate((("assign", ASSIGN, good), ("access", ACCESS, places(text, ACCESS)),
                                                  ("hex", HEX, places(text, HEX))))]


def _weight(c: Column) -> Column:
    """c * log2(c), 0 for 0."""
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(0.0)


def _stretch_spans(codes: Column, before: Column, alphabet: int, least: float, window: int) -> Column:
    """(start, end) of what windows of enough entropy cover in a stretch of
    codes, merged; ``before`` is what stands before the stretch."""
    words = [f"w{k}" for k in range(-(-alphabet // PACKED))]
    limit = F.log2(F.lit(float(window))) - least  # S / n of a window may be this at most

    def unit(code: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), (code % PACKED * COUNT_BITS).cast("int"))

    def count(acc: Column, code: Column) -> Column:
        word = acc[words[0]]
        for k, name in enumerate(words[1:], 1):
            word = F.when(code >= k * PACKED, acc[name]).otherwise(word)
        return F.call_function("shiftright", word, (code % PACKED * COUNT_BITS).cast("int")).bitwiseAND((1 << COUNT_BITS) - 1)

    def step(acc: Column, i: Column) -> Column:
        enters, leaves = F.get(codes, i), F.get(codes, i - window)
        full, same = i >= window, enters == leaves

        def updated(c: Column) -> Column:
            # a character that enters as its like leaves changes nothing
            s = acc["s"] + F.when(full & same, 0.0).otherwise(
                _weight(c["in"] + 1) - _weight(c["in"]) + F.when(full, _weight(c["out"] - 1) - _weight(c["out"])).otherwise(0.0))
            hit = (i >= window - 1) & (s / float(window) <= limit + 1e-9)
            last = F.get(acc["out"], F.size(acc["out"]) - 1)
            joins = F.coalesce(last["end"] >= before + i - window + 1, F.lit(False))
            begin, end = before + i - window + 1, before + i + 1
            out = F.when(~hit, acc["out"]).when(joins, F.concat(
                F.slice(acc["out"], F.lit(1), F.size(acc["out"]) - 1), F.array(F.struct(last["start"].alias("start"), end.alias("end")))
            )).otherwise(F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end")))))
            counts = [(acc[name] + F.when(F.floor(enters / PACKED) == k, unit(enters)).otherwise(F.lit(0).cast("long"))
                       - F.when(full & (F.floor(leaves / PACKED) == k), unit(leaves)).otherwise(F.lit(0).cast("long"))).alias(name)
                      for k, name in enumerate(words)]
            return F.struct(*counts, s.alias("s"), out.alias("out"))
        return let(F.struct(count(acc, enters).alias("in"), F.coalesce(count(acc, leaves), F.lit(0).cast("long")).alias("out")), updated)

    start = F.struct(*[F.lit(0).cast("long").alias(name) for name in words], F.lit(0.0).alias("s"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step)["out"]


def merged(spans: Column) -> Column:
    """Spans in order of start, with those that touch or overlap made one; no
    span may lie in one before it."""
    begins = F.filter(spans, lambda x, k: F.coalesce(F.get(spans, k - 1)["end"] < x["start"], F.lit(True)))
    ends = F.filter(spans, lambda x, k: F.coalesce(F.get(spans, k + 1)["start"] > x["end"], F.lit(True)))
    return F.zip_with(begins, ends, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))


def marked(run: Column, alphabet: str, least: float, window: int = WINDOW) -> Column:
    """(start, end) of what windows of enough entropy cover in a string, merged."""
    if window >= 1 << COUNT_BITS:
        raise ValueError(f"a window has at most {(1 << COUNT_BITS) - 1} characters")

    def stretches(codes: Column) -> Column:
        # each begins with the characters before that its first window needs
        return let(F.flatten(F.transform(F.sequence(F.lit(0), F.floor((F.size(codes) - 1) / STRETCH).cast("int")), lambda k: let(
            F.greatest(F.lit(0), k * STRETCH - (window - 1)), lambda first: let(
                F.slice(codes, first + 1, (k + 1) * STRETCH - first), lambda part: _stretch_spans(
                    part, first, len(alphabet), least, window))))), merged)

    # places in the alphabet, from 0
    codes = F.transform(F.split(run, ""), lambda ch: F.instr(F.lit(alphabet), ch) - 1)
    return F.when(F.length(run) < window, F.array().cast("array<struct<start:int,end:int>>")).otherwise(let(codes, stretches))


def _parts_far_from(run: Column, allowed: str = ALLOWED) -> Column:
    """(m, start): the parts of a string that are NEAR characters or more from
    every match of the allow-list; all of it if there is none."""
    def cut(s: Column) -> Column:
        # a part lies between the end of one match and the start of the next
        ends = F.concat(F.array(F.lit(-NEAR)), F.transform(s["hits"], lambda h: h["end"]))
        return let(ends, lambda e: F.transform(e, lambda lo, k: let(F.struct(
            (lo + NEAR).alias("lo"), (F.coalesce(F.get(s["hits"], k)["start"], F.length(s["run"]) + NEAR) - NEAR).alias("hi")),
            lambda p: F.struct(F.substr(s["run"], p["lo"] + 1, F.greatest(F.lit(0), p["hi"] - p["lo"])).alias("m"), p["lo"].alias("start")))))
    return F.when(F.regexp_like(run, F.lit(allowed)), let(F.struct(run.alias("run"), places(run, allowed).alias("hits")), cut)).otherwise(
        F.array(F.struct(run.alias("m"), F.lit(0).alias("start"))))


def entropy_spans(text: Column, window: int = WINDOW) -> Column:
    """The spans that the entropy method adds."""
    mixed = F.filter(places(text, CANDIDATE), lambda x: F.regexp_like(x["m"], F.lit("[0-9]"))
                     & F.regexp_like(x["m"], F.lit("[A-Za-z]")))
    parts = F.flatten(F.transform(mixed, lambda x: F.transform(_parts_far_from(x["m"]), lambda y: F.struct(
        x["m"].alias("whole"), y["m"].alias("m"), (x["start"] + y["start"]).alias("start")))))
    kinds = []
    for k, (kind, pattern, alphabet, least) in enumerate(ENTROPY_KINDS):
        kinds.append(lambda found, k=k, kind=kind, pattern=pattern, alphabet=alphabet, least=least: F.flatten(F.transform(
            F.filter(found, lambda x: F.regexp_like(x["whole"], F.lit(f"^{pattern}$"))),
            lambda x: F.transform(marked(x["m"], alphabet, least, window), lambda y: F.struct(
                (x["start"] + y["start"]).alias("start"), F.lit(3 + k).alias("order"),
                (x["start"] + y["end"]).alias("end"), F.lit(kind).alias("kind"))))))
    return F.when(F.regexp_like(text, F.lit(CANDIDATE)), let(
        parts, lambda found: F.concat(*[kind(found) for kind in kinds]))).otherwise(_none())


def joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, with commas between."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per document."""
    text = F.col("text")
    kinds = ("assign", "access", "hex")
    found = docs.select("doc_id", text_or_empty().alias("text")).select(
        "doc_id", *[c.alias(k) for k, c in zip(kinds, base_spans(text))], entropy_spans(text, window).alias("more"))
    base = F.concat(*kinds)
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in kinds],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.concat(base, F.col("more"))).alias("spans"))
