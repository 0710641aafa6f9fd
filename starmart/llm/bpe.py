"""Byte-pair encoding by last-token states.

The encoding of a word under merges is fixed by its prefixes: the encoding of
``w[:i]`` is that of ``w[:i - len(t)]`` followed by one last token ``t``, and
``t`` is the only vocabulary suffix of ``w[:i]`` that can stand beside the last
token of the shorter prefix.  So one state for each prefix (last token, and
where it starts) gives the encoding and the exact token count of all prefixes
in one pass, without running merges over the word.

Two tokens can stand side by side if no merge joins them across their border
before both are complete; ``Merges.joined`` decides it by running the merges
over the two tokens' symbols alone, and remembers the answer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

#: Borders and prefixes remembered by a worker; a memory bound, not a limit on results.
REMEMBERED = 400_000
#: Characters of the longest prefix that is remembered.
REMEMBERED_LENGTH = 32


class Merges:
    """A vocabulary and its merge order.

    ``ids`` maps token strings to ids; ``rank(left, right)`` gives the priority
    of merging two token strings (lower first, leftmost first among equals) or
    None; ``symbols`` splits a token string into the symbols merging starts with.
    """

    def __init__(self, ids: dict[str, int], rank: Callable, symbols: Callable = list):
        self.ids, self.rank, self.symbols = ids, rank, symbols
        #: Every ending of a token: whether it is itself a token.
        self.tails = {t[i:]: False for t in ids for i in range(len(t))} | dict.fromkeys(ids, True)
        #: Characters at a prefix's end that decide its last token (more, so that remembered prefixes are whole).
        self.reach = max(REMEMBERED_LENGTH + 1, max(map(len, ids), default=1))
        self._prefix: dict[str, str] = {}
        self._whole: dict[str, bool] = {}
        self._border: dict[tuple[str, str], bool] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """The merges run in their order over a short list of symbols."""
        parts = list(symbols)
        ranks = [self.rank(a, b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                return parts
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = self.rank(parts[i - 1], parts[i])
            if i < len(ranks):
                ranks[i] = self.rank(parts[i], parts[i + 1])

    def whole(self, token: str) -> bool:
        """Whether merging reaches this token from its own symbols."""
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = token in self.ids and self.merged(self.symbols(token)) == [token]
        return known

    def joined(self, left: str, right: str) -> bool:
        """Whether ``right`` can follow ``left`` in an encoding."""
        known = self._border.get((left, right))
        if known is None:
            if len(self._border) >= REMEMBERED:
                self._border.clear()
            known = self.whole(right) and self.merged(self.symbols(left) + self.symbols(right)) == [left, right]
            self._border[left, right] = known
        return known

    def last(self, prefix: str, before: list[str], end: str = "") -> str:
        """The last token of a prefix whose final symbol carries the mark ``end``.

        ``before[i]`` is the last token of its first ``i`` symbols ("" for none),
        for all shorter prefixes; of the prefix itself the last ``reach`` symbols do.
        """
        text = prefix + end
        skipped = len(before) - len(prefix)
        tails, found, start = self.tails, [], len(prefix) - 1
        while start >= 0:
            token = text[start:]
            ends = tails.get(token)
            if ends is None:
                break
            if ends:
                found.append((start + skipped, token))
            start -= 1
        border = self._border
        for start, token in reversed(found):
            if self.whole(token) if not start else border.get((before[start], token)) or self.joined(before[start], token):
                return token
        raise ValueError(f"no token ends at {text[-40:]!r}")

    def state(self, prefix: str, before: list[str]) -> str:
        """``last`` of an unmarked prefix, remembered: words share many of them."""
        token = self._prefix.get(prefix)
        if token is None:
            if len(self._prefix) >= REMEMBERED:
                self._prefix.clear()
            token = self.last(prefix, before)
            if len(prefix) <= REMEMBERED_LENGTH:
                self._prefix[prefix] = token
        return token


def prefix_counts(merges: Merges, word: str) -> list[int]:
    """Token counts of all prefixes of a word: entry i is that of ``word[:i]``."""
    last, counts, reach = [""], [0], merges.reach
    for i in range(1, len(word) + 1):
        token = merges.state(word[:i], last) if i <= REMEMBERED_LENGTH else merges.last(word[max(0, i - reach) : i], last)
        last.append(token)
        counts.append(counts[i - len(token)] + 1)
    return counts


class Trie:
    """Distinct words by their characters; shared prefixes are stored once."""

    END = ""

    def __init__(self, words: Iterable[str]):
        self.root: dict = {}
        for word in words:
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node[self.END] = word


def trie_encode(merges: Merges, words: Iterable[str], end: str = "") -> dict[str, list[int]]:
    """Ids of every distinct word, its last symbol carrying the mark ``end``.

    A depth-first walk keeps the last-token states of the path it stands on, so
    a prefix that many words share is worked out once for all of them.  Only the
    end of a long path is kept as text, so the work is linear in a word's length.
    """
    out: dict[str, list[int]] = {}
    last = [""]
    stack = [(child, c, 1) for c, child in Trie(words).root.items() if c]
    ids, reach = merges.ids, merges.reach
    while stack:
        node, prefix, depth = stack.pop()
        del last[depth:]
        inner = len(node)
        if Trie.END in node:
            inner -= 1
            token = merges.last(prefix, last, end)
            back, at = [ids[token]], depth - (len(token) - len(end))
            while at:
                token = last[at]
                back.append(ids[token])
                at -= len(token)
            back.reverse()
            out[node[Trie.END]] = back
        if inner:
            last.append(merges.state(prefix, last))
            for c, child in node.items():
                if c:
                    stack.append((child, (prefix + c)[-reach:], depth + 1))
    return out
