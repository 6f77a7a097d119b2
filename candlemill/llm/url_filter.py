"""URL filters: allow and block rules in a trie over reversed host labels and path parts.

The rule list is small beside the pages and is compiled into one trie that every executor
gets once; each URL walks it from the top-level domain inward, then along its path.
"""

import pandas as pd
from pyspark.sql import functions as F

#: Most rules a trie may be built of, and most characters in all: it is sent to every executor.
MOST_RULES = 1_000_000
MOST_RULE_CHARS = 100_000_000

#: Rules of the registered query, ``(rule, verdict)``.
RULES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
]

_HERE = "\0rule"
_PATHS = "\0paths"


def host_of(url):
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(
        F.translate(
            F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1),
            "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
            "abcdefghijklmnopqrstuvwxyz",
        ),
        F.lit(""),
    )


def path_of(url):
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


class RuleTrie:
    """Host labels from the right; below a host, its rules' paths in parts that end with ``/``.

    The last part of a rule's path may be open (no ``/`` at its end): it matches by its
    beginning, so a path fits as soon as it starts with the rule's.
    """

    def __init__(self, rules=(), root=None):
        self.root = {} if root is None else root
        for rule, verdict in rules:
            host, slash, rest = rule.partition("/")
            node = self.root
            for label in reversed(host.lower().split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(_PATHS, {})
            *whole, last = (slash + rest).split("/") if slash else [""]
            for part in whole:
                node = node.setdefault(part + "/", {})
            if last:
                node = node.setdefault("\0open", {}).setdefault(last, {})
            # Equal rules with other verdicts: block wins.
            if node.get(_HERE, (rule, "allow"))[1] == "allow":
                node[_HERE] = (rule, verdict)

    @staticmethod
    def _along(paths, path):
        """The rule with the longest path that ``path`` starts with."""
        best, node, at = paths.get(_HERE), paths, 0
        while node is not None:
            rest = path[at:]
            fits = [r for r in node.get("\0open", ()) if rest.startswith(r)]
            if fits:
                best = node["\0open"][max(fits, key=len)][_HERE]
            cut = path.find("/", at)
            if cut < 0:
                break
            node = node.get(path[at : cut + 1])
            at = cut + 1
            if node is not None and _HERE in node:
                best = node[_HERE]
        return best

    def find(self, host, path):
        """The longest rule that fits: most host labels first, then the longest path."""
        best, node = None, self.root
        if not host:
            return None
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if _PATHS in node:
                best = self._along(node[_PATHS], path) or best
        return best


def filter_urls(pages, rules=RULES, default="allow"):
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` of each row's ``url``.

    ``rules`` are pairs of a rule such as ``example.net/en/`` (host, then path) and ``allow``
    or ``block``. A rule fits its host and all subdomains if the URL's path starts with the
    rule's; the longest wins: most host labels, then the longest path. ``rule`` is NULL and
    ``verdict`` is ``default`` where none fits. Columns of these names are replaced.

    * NULL URLs and those without ``://``: host and path are empty and no rule fits.
    * Equal rules with both verdicts block. Every row is judged; equal rows stay.
    """
    rules = list(rules)
    if len(rules) > MOST_RULES or sum(len(r) for r, _ in rules) > MOST_RULE_CHARS:
        raise ValueError("too many rules for a broadcast trie")
    trie = pages.sparkSession.sparkContext.broadcast(RuleTrie(rules).root)

    @F.pandas_udf("rule string, verdict string")
    def judge(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        find = RuleTrie(root=trie.value).find
        found = [find(h, p) or (None, default) for h, p in zip(hosts, paths)]
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    rows = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    judged = rows.withColumn("_judged", judge("host", "path"))
    return judged.withColumn("rule", F.col("_judged.rule")).withColumn("verdict", F.col("_judged.verdict")).drop("_judged")
