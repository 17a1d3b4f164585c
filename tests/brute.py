"""Plain re-statements of the rules over all pairs, for small fixtures."""

from __future__ import annotations

from itertools import count


def similarity(a: str, b: str) -> int:
    if a == b:
        return 100
    if not a or not b:
        return 0
    prev = [0] * (len(b) + 1)
    for ch in a:
        cur = [0]
        for j, other in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if other == ch else max(prev[j], cur[-1]))
        prev = cur
    total = len(a) + len(b)
    return round(100 * (1 - (total - 2 * prev[-1]) / total))


def normal(name: str) -> str:
    """Letters and digits of the lower-cased name; white space other than blanks stays inside."""
    return "".join(ch for ch in name.strip().lower() if ch.isalnum() or (ch.isspace() and ch != " "))


def resolve(name: str, mappings: dict[str, list[str]], low: int = 85):
    """(standard, strategy): the smallest of all offers, each a sort key with its outcome."""
    offers = []
    for at, (standard, variations) in enumerate(mappings.items()):
        if name in variations:
            offers.append(((0, at, 0), (standard, "exact")))
        if any(name.strip().lower() == v.lower() for v in variations):
            offers.append(((0, at, 1), (standard, "case_insensitive")))
        offers += [((1, -similarity(normal(name), normal(v)), at), (standard, "fuzzy")) for v in variations]
        offers.append(((2, -similarity(normal(name), normal(standard)), at), (standard, "standard_name")))
    good = [(key, outcome) for key, outcome in offers if key[0] == 0 or -key[1] >= low]
    return min(good)[1] if good else None


def assign(names: list[str], standards: list[str], above: int = 70) -> dict[str, str]:
    """name -> standard, one name after the other in sorted order."""
    squeeze = str.maketrans("", "", "_ ")
    homes = [(s, s.lower().replace("_", "")) for s in standards]
    out = {}
    for name in sorted(names):
        form = name.lower().translate(squeeze)
        offers = [(-similarity(form, known), at) for at, (_, known) in enumerate(homes)]
        score, at = min(offers, default=(0, None))
        if -score <= above:
            homes.append((name.lower().replace(" ", "_"), form))
            at = len(homes) - 1
        out[name] = homes[at][0]
    return out


def free_names(items: list[tuple[int, str]], taken=()) -> dict[int, str]:
    used, out = set(taken), {}
    for i, slug in sorted(items):
        tries = (slug if k == 0 else f"{slug}_{k}" for k in count())
        out[i] = next(t for t in tries if t not in used)
        used.add(out[i])
    return out
