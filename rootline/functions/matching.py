"""Failure hints and components of a text, found in one pass of an automaton over all their words.

The ordered rules (``text.HINTS``, ``text.COMPONENTS``) ask one pattern after the other whether it stands in the text as a
whole word, and the first one that does decides.  Here one Aho-Corasick automaton finds every pattern in one reading of the
text, and the least rank among the whole words found is the same decision; the cost of a text no longer grows with the
number of rules.  Hints ignore case and take any white space between their words; components are sought in the actor as it
stands, then in the lower-case text.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as X

# The component that shares its pods with another one's name, and that name.
SHARED_NAME = ("milvus-core", "milvus-etcd")


def labels(message: Column, actor: Column, text: Column, hints=X.HINTS, components=X.COMPONENTS, shared=SHARED_NAME) -> Column:
    """(hint, component) of each row: the hint of ``message``, the component of ``actor`` and ``text``; hint is null without one."""
    ranked = [(c, p) for found in components.values() for c, words in found.items() for p in words]

    # everything a worker runs is defined in here, so that it needs no copy of this package
    @F.arrow_udf("hint string, component string")
    def found(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        import ahocorasick
        import pyarrow as pa

        # letters that match i, s and k when case is ignored, but are not lower-cased to them
        like = {0x130: "i", 0x131: "i", 0x17F: "s", 0x212A: "k"}

        def automaton(patterns):
            a, least = ahocorasick.Automaton(), {}
            for rank, p in enumerate(patterns):
                least.setdefault(p, rank)
            for p, rank in least.items():
                a.add_word(p, (rank, len(p)))
            a.make_automaton()
            return a

        by_hint, by_component = automaton([w for w, _ in hints]), automaton([p for _, p in ranked])
        inside = lambda c: c.isalnum() or c == "_"

        def whole(a, t):
            """Ranks of the patterns that stand in the text as whole words."""
            out, n = [], len(t)
            for end, (rank, size) in a.iter(t):
                first = end - size
                if (first < 0 or not inside(t[first])) and (end + 1 == n or not inside(t[end + 1])):
                    out.append(rank)
            return out

        def hint(m):
            ranks = whole(by_hint, " ".join((m if m.isascii() else m.translate(like)).lower().split()))
            return hints[min(ranks)][1] if ranks else None

        def component(who, told):
            if shared[1] in told or shared[1] in who.lower():
                if any(ranked[r][0] == shared[0] for t in (who.lower(), told) for r in whole(by_component, t)):
                    return shared[0]
            for t in (who, told):
                if t and (ranks := whole(by_component, t)):
                    return ranked[min(ranks)][0]
            return "unknown_component"

        for messages, actors, texts in parts:
            said = [hint(m) if m else None for m in messages.to_pylist()]
            named = [component(who or "", (told or "").lower()) for who, told in zip(actors.to_pylist(), texts.to_pylist())]
            yield pa.StructArray.from_arrays([pa.array(said, pa.string()), pa.array(named, pa.string())], ["hint", "component"])

    return found(message, actor, text)
