"""Plain Python statements of the rules, to compare the expressions with."""

from fractions import Fraction

from instructspark import fixed_values as fixed


def has_marker(line):
    return any(marker in line.lower() for marker in fixed.PREAMBLE_MARKERS)


def reason_and_text(response, original):
    original = original or ""
    if response is None:
        return "missing", original
    bare = response.strip()
    if len(bare) < 10:
        return "short", original
    if bare.lower().startswith(tuple(fixed.PREAMBLE_MARKERS)):
        lines = [line.strip() for line in bare.split("\n")]
        usable = [line for line in lines if len(line) > 30 and not has_marker(line)]
        return ("marker_line", usable[0]) if usable else ("marker_only", original)
    known = set(original.lower().split())
    shared = known.intersection(bare.lower().split())
    if len(shared) / max(1, len(known)) < 0.3:
        return "overlap", original
    if len(bare) > 50 + 3 * len(original):
        return "runaway", original
    return "ok", bare


def skipped(text, reference):
    bare = (text or "").strip()
    return len(bare) < 5 or bare == (reference or "").strip()


def label(text):
    lowered = (text or "").lower()
    hits = (name for name, words in fixed.TASK_KEYWORDS.items() if any(w in lowered for w in words))
    return next(hits, "other")


def language(text):
    if not (text or "").strip():
        return 0.0
    own = sum(text.count(letter) for letter in fixed.LANGUAGE_ALPHABET)
    return 0.5 + min(0.5, own / (len(text) * 0.02))


def length(text, reference):
    """With exact fractions instead of floating point."""
    share = Fraction(len(text), max(1, len(reference)))
    for bounds, score in ((fixed.LENGTH_FULL, 1.0), (fixed.LENGTH_HALF, 0.5)):
        low, high = (Fraction(str(bound)) for bound in bounds)
        if low <= share <= high:
            return score
    return 0.0


def accuracy(text, reference, task):
    if task not in fixed.VERIFIABLE_TASKS:
        return 0.0
    said, wanted = text.strip().lower(), reference.strip().lower()
    if said == wanted:
        return 1.0
    return 0.5 if said in wanted or wanted in said else 0.0
