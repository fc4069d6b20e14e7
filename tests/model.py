"""The sequence operators from their definitions: cut the tokens into maximal
runs of a class, then apply each run's rule. Tokens are (tag, value, ent)."""

from itertools import dropwhile, groupby

ORG = "ORGANIZATION"


def kind(tag):
    return next((k for k, p in (("R", "RB"), ("J", "JJ"), ("C", "CC"), ("N", "NN"), ("V", "VB"), ("D", "IN"), ("D", "DT"))
                 if tag.startswith(p)), "X")


def described(tokens):
    """Each adjective with the adverbs right before it."""
    kinds = [kind(t) for t, _, _ in tokens]
    out = []
    for i, k in enumerate(kinds):
        if k == "J":
            start = i
            while start and kinds[start - 1] == "R":
                start -= 1
            out.append(" ".join(v for _, v, _ in tokens[start:i + 1]))
    return out


def direct_pairs(seq, flush_tail=False):
    """A run of adverbs, adjectives, conjunctions and nouns that something
    follows: its last nouns get each of its adjectives."""
    runs = [(inside, list(ts)) for inside, ts in groupby(seq, key=lambda t: kind(t[0]) in "RJCN")]
    out = []
    for number, (inside, tokens) in enumerate(runs):
        if inside and (flush_tail or number + 1 < len(runs)):
            last, nouns = [(k, list(ts)) for k, ts in groupby(tokens, key=lambda t: kind(t[0]))][-1]
            if last == "N":
                out += [(True, " ".join(v for _, v, _ in nouns), a) for a in described(tokens)]
    return out


def connected_pairs(seq, skip_articles=False, flush_tail=False):
    """Nouns, be, adverbs/adjectives/conjunctions, and what ends them, found
    from left to right without overlap."""
    kinds = [kind(t) for t, _, _ in seq]
    middle = "RJCD" if skip_articles else "RJC"
    out, at, n = [], 0, len(seq)

    def end(start, classes):
        return next((i for i in range(start, n) if kinds[i] not in classes), n)

    while at < n:
        if kinds[at] != "N":
            at += 1
            continue
        verb = end(at, "N")
        if verb == n or kinds[verb] != "V" or seq[verb][1] != "be":
            at = verb
            continue
        stop = end(verb + 1, middle)
        if stop < n or flush_tail:
            noun = " ".join(v for _, v, _ in seq[at:verb])
            adjs = described([t for t in seq[verb + 1:stop] if kind(t[0]) != "D"])
            if stop < n and kinds[stop] == "N":
                adjs = [f"{a} {seq[stop][1]}" for a in adjs] + [seq[stop][1]]
            out += [(False, noun, a) for a in adjs]
        at = stop + 1
    return out


def org_mentions(seq, flush_tail=False):
    """Runs of organization tokens that something follows; empty words before
    the first are skipped."""
    runs = [(org, [v for _, v, _ in ts]) for org, ts in groupby(seq, key=lambda t: t[2] == ORG)]
    named = [" ".join(dropwhile(lambda v: not v, vs)) for i, (org, vs) in enumerate(runs) if org and (flush_tail or i + 1 < len(runs))]
    return [m for m in named if m]


def combine_orgs(seq):
    """Each run of organization tokens as one, under its first tag."""
    out = []
    for org, ts in groupby(seq, key=lambda t: t[2] == ORG):
        ts = list(ts)
        out += [(ts[0][0], "_".join(v for _, v, _ in ts), ORG)] if org else ts
    return out
