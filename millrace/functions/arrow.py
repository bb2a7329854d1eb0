"""Functions that no built-in expresses, over Arrow batches: normal forms, syntax trees, parsers, common substrings."""

from __future__ import annotations

import ast
import hashlib
import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType


#: Characters of texts that are Python strings at once, and characters a worker parses itself before it leaves that to children.
SLICE, OWN = 1 << 20, 4 << 20


def _slices(values):
    """Lists of Python strings of about ``SLICE`` characters; nulls are empty."""
    part, size = [], 0
    for v in values:
        part.append(v.as_py() or "")
        size += len(part[-1])
        if size >= SLICE:
            yield part
            part, size = [], 0
    if part:
        yield part


def _each(values: pa.Array, fn, kind: pa.DataType) -> pa.Array:
    """``fn`` of each text; only a slice's texts and results are Python's at a time, whatever a batch holds."""
    parts = [pa.array(list(map(fn, part)), kind) for part in _slices(values)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _apart(fn, texts: list[str]) -> list:
    """``fn`` of each text, computed in a child process."""
    import os
    import pickle

    read, write = os.pipe()
    child = os.fork()
    if not child:
        try:
            os.close(read)
            with os.fdopen(write, "wb") as out:
                pickle.dump(list(map(fn, texts)), out)
            os._exit(0)
        finally:
            os._exit(1)
    os.close(write)
    with os.fdopen(read, "rb") as found:
        data = found.read()
    if os.waitpid(child, 0)[1]:
        raise RuntimeError("a child that parsed texts failed")
    return pickle.loads(data)


def _parsed(values: pa.Array, fn, kind: pa.DataType) -> pa.Array:
    """``fn`` of each text, where ``fn`` parses Python; equal texts of a batch are parsed once.

    The parser keeps every name it meets for as long as the process lives, and workers live on from task to task. So a worker
    parses a few MB itself, then each slice in a child of its own, whose names go with it.
    """
    import sys

    held = sys.__dict__.setdefault("_millrace_parsed", [0])  # of the process: functions are pickled by value
    coded = values.dictionary_encode()
    parts = []
    for part in _slices(coded.dictionary):
        held[0] += sum(map(len, part))
        parts.append(pa.array(list(map(fn, part)) if held[0] <= OWN else _apart(fn, part), kind))
    null = len(coded.dictionary)
    parts.append(pa.array([fn("")], kind))
    return pa.concat_arrays(parts).take(coded.indices.fill_null(null))


@arrow_udf(StringType())
def _nfkc(values: pa.Array) -> pa.Array:
    return _each(values, lambda s: unicodedata.normalize("NFKC", s), pa.string())


def nfkc(c: Column) -> Column:
    """Compatibility composition. ASCII texts are fixed points and never reach Python's normaliser in effect."""
    once = _nfkc.asNondeterministic()  # it isn't, but what reads the column must not have its expression pasted in at each mention
    return F.when(c.rlike(r"[^\x00-\x7F]"), once(F.when(c.rlike(r"[^\x00-\x7F]"), c))).otherwise(c)


def python_valid(text: str) -> bool:
    try:
        ast.parse(text)
        return True
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return False


class SqlSyntax:
    """Whether a text is statements of SQL, by recursive descent over a subset of the language.

    queries     [WITH name [(cols)] AS (query), ...] SELECT [DISTINCT] items [FROM tables, joins] [WHERE] [GROUP BY] [HAVING] [WINDOW]
                [ORDER BY] [LIMIT] [OFFSET], set operations, VALUES, parentheses
    changes     INSERT INTO .. [(cols)] query, UPDATE .. SET .. [FROM] [WHERE], DELETE FROM .. [USING] [WHERE], with RETURNING
    tables      CREATE [OR REPLACE] [TEMPORARY] TABLE [IF NOT EXISTS] name (columns) | AS query, CREATE VIEW, CREATE INDEX, ALTER TABLE,
                DROP, TRUNCATE
    expressions operators, CASE, CAST and ::, IN, BETWEEN, LIKE, IS, EXISTS, calls with OVER and FILTER, intervals, subqueries

    Column definitions and ALTER actions are read as balanced words. Other statements aren't SQL to this.
    """

    TOKEN = re.compile(r"""(\s+|--[^\n]*|/\*.*?\*/)|('(?:[^']|'')*'|\$\$.*?\$\$)|("(?:[^"]|"")+"|`[^`]+`|\[[A-Za-z_][^\]]*\])|((?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)|([A-Za-z_\u0080-\uffff][\w$]*)|(::|<>|<=|>=|!=|\|\||->>|->|[-+*/%=<>(),.;:?@^&|~\[\]])""", re.DOTALL)
    RESERVED = set("select from where group having order limit offset union except intersect on using join inner left right full cross natural when then else end and or not in is like ilike between case as set values returning window by into distinct with".split())
    DEEPEST = 200

    def __init__(self, text: str):
        self.kinds, self.words, at = [], [], 0
        while at < len(text):
            m = self.TOKEN.match(text, at)
            if not m:
                raise ValueError(at)
            at = m.end()
            if m.lastindex > 1:
                self.kinds.append(" snkwo"[m.lastindex - 1] if m.lastindex != 3 else "i")
                self.words.append(m.group().lower() if m.lastindex in (5, 6) else m.group())
        self.at, self.depth, self.no_query = 0, 0, set()

    def peek(self, *words: str) -> bool:
        return self.at < len(self.words) and self.kinds[self.at] in "wo" and self.words[self.at] in words

    def took(self, *words: str) -> bool:
        found = self.peek(*words)
        self.at += found
        return found

    def need(self, *words: str) -> None:
        if not self.took(*words):
            raise ValueError(self.at)

    def phrase(self, *words: str) -> bool:
        """Takes these words in a row, or nothing."""
        at = self.at
        if all(self.took(w) for w in words):
            return True
        self.at = at
        return False

    def name(self) -> None:
        self.ident()
        while self.took("."):
            if not self.took("*"):
                self.ident()

    def ident(self) -> None:
        if self.at >= len(self.words) or not (self.kinds[self.at] == "i" or (self.kinds[self.at] == "w" and self.words[self.at] not in self.RESERVED)):
            raise ValueError(self.at)
        self.at += 1

    def is_ident(self) -> bool:
        return self.at < len(self.words) and (self.kinds[self.at] == "i" or (self.kinds[self.at] == "w" and self.words[self.at] not in self.RESERVED))

    def each(self, rule) -> None:
        rule()
        while self.took(","):
            rule()

    def names_in_brackets(self) -> None:
        self.need("(")
        self.each(self.name)
        self.need(")")

    def statements(self) -> bool:
        n = 0
        while self.at < len(self.words):
            if self.took(";"):
                continue
            self.statement()
            n += 1
            if self.at < len(self.words):
                self.need(";")
        return n > 0

    def statement(self) -> None:
        if self.peek("select", "with", "values", "("):
            self.query()
        elif self.phrase("insert", "into"):
            self.name()
            if self.peek("(") and self.words[self.at + 1 : self.at + 2] != ["select"]:
                self.names_in_brackets()
            self.query()
            self.returning()
        elif self.took("update"):
            self.table()
            self.need("set")
            self.each(self.assignment)
            if self.took("from"):
                self.each(self.joined)
            self.condition()
        elif self.phrase("delete", "from"):
            self.table()
            if self.took("using"):
                self.each(self.joined)
            self.condition()
        elif self.took("create"):
            self.create()
        elif self.phrase("alter", "table") or self.phrase("drop", "table") or self.phrase("drop", "view") or self.phrase("drop", "index") or self.phrase("truncate", "table") or self.took("truncate"):
            self.phrase("if", "exists")
            self.name()
            self.balanced()
        else:
            raise ValueError(self.at)

    def assignment(self) -> None:
        self.name()
        self.need("=")
        self.expression()

    def condition(self) -> None:
        if self.took("where"):
            self.expression()
        self.returning()

    def returning(self) -> None:
        if self.took("returning"):
            self.each(self.item)

    def create(self) -> None:
        self.phrase("or", "replace")
        self.took("temporary", "temp", "unique", "materialized")
        if not self.took("table", "view", "index"):
            raise ValueError(self.at)
        self.phrase("if", "not", "exists")
        self.name()
        if self.took("on"):  # an index
            self.name()
        if self.peek("("):
            self.balanced(1)
        if self.took("as"):
            self.query()
        else:
            self.balanced()

    def balanced(self, groups: int = 0) -> None:
        """Words up to the end of the statement, or a number of bracketed groups."""
        open_ = 0
        while self.at < len(self.words) and not (self.peek(";") and not open_):
            open_ += self.peek("(") - self.peek(")")
            if open_ < 0:
                raise ValueError(self.at)
            self.at += 1
            if groups and not open_:
                return
        if open_:
            raise ValueError(self.at)

    def query(self) -> None:
        if self.took("with"):
            self.took("recursive")
            self.each(self.shared)
        self.part()
        while self.took("union", "except", "intersect"):
            self.took("all", "distinct")
            self.part()
        if self.phrase("order", "by"):
            self.each(self.ordered)
        for word in ("limit", "offset", "limit"):
            if self.took(word):
                self.expression()
                if self.took(","):
                    self.expression()

    def shared(self) -> None:
        self.ident()
        if self.peek("("):
            self.names_in_brackets()
        self.need("as")
        self.bracketed()

    def bracketed(self) -> None:
        self.need("(")
        self.deeper(self.query)
        self.need(")")

    def took_query(self) -> bool:
        """Takes a query in brackets, or nothing. Where one was looked for in vain is remembered, so time stays linear."""
        at, depth, ahead = self.at, self.depth, self.at
        while ahead < len(self.words) and self.words[ahead] == "(":
            ahead += 1
        if at in self.no_query or ahead >= len(self.words) or self.words[ahead] not in ("select", "with", "values"):
            return False
        try:
            self.bracketed()
            return True
        except ValueError:
            self.no_query.add(at)
            self.at, self.depth = at, depth
            return False

    def deeper(self, rule) -> None:
        self.depth += 1
        if self.depth > self.DEEPEST:
            raise ValueError(self.at)
        rule()
        self.depth -= 1

    def part(self) -> None:
        if self.peek("("):
            return self.bracketed()
        if self.took("values"):
            return self.each(self.row)
        self.need("select")
        self.took("distinct", "all")
        self.each(self.item)
        if self.took("from"):
            self.each(self.joined)
        if self.took("where"):
            self.expression()
        if self.phrase("group", "by"):
            self.each(self.expression)
        if self.took("having"):
            self.expression()
        return None

    def row(self) -> None:
        self.need("(")
        self.each(self.expression)
        self.need(")")

    def item(self) -> None:
        if self.took("*"):
            return
        self.expression()
        if self.took("as") or self.is_ident():
            self.ident()

    def table(self) -> None:
        if self.peek("("):
            if not self.took_query():
                self.need("(")
                self.deeper(self.joined)
                self.need(")")
        else:
            self.name()
            if self.peek("("):
                self.arguments()
        if self.took("as") or self.is_ident():
            self.ident()
            if self.peek("("):
                self.names_in_brackets()

    def joined(self) -> None:
        self.took("lateral")
        self.table()
        while True:
            kind = self.took("natural", "cross", "inner", "left", "right", "full")
            self.took("outer")
            if not self.took("join"):
                if kind:
                    raise ValueError(self.at)
                return
            self.took("lateral")
            self.table()
            if self.took("on"):
                self.expression()
            elif self.took("using"):
                self.names_in_brackets()

    def ordered(self) -> None:
        self.expression()
        self.took("asc", "desc")
        if self.took("nulls"):
            self.need("first", "last")

    def expression(self) -> None:
        self.deeper(self.conjunction)

    def conjunction(self) -> None:
        while True:
            while self.took("not"):
                pass
            self.comparison()
            if not self.took("and", "or"):
                return

    def comparison(self) -> None:
        self.sum()
        while True:
            if self.took("=", "<", ">", "<=", ">=", "<>", "!="):
                self.took("any", "all", "some")
                self.sum()
            elif self.took("is"):
                self.took("not")
                self.need("null", "true", "false", "unknown", "distinct")
                if self.took("from"):
                    self.sum()
            else:
                at = self.at
                self.took("not")
                if self.took("in"):
                    self.need("(")
                    if self.peek("select", "with"):
                        self.deeper(self.query)
                    else:
                        self.each(self.expression)
                    self.need(")")
                elif self.took("between"):
                    self.sum()
                    self.need("and")
                    self.sum()
                elif self.took("like", "ilike"):
                    self.sum()
                else:
                    self.at = at
                    return

    def sum(self) -> None:
        self.unary()
        while self.took("+", "-", "*", "/", "%", "||", "->", "->>", "^", "&", "|"):
            self.unary()

    def unary(self) -> None:
        while self.took("+", "-", "~"):
            pass
        self.primary()
        while True:
            if self.took("::"):
                self.kind()
            elif self.took("["):
                self.expression()
                self.need("]")
            else:
                return

    def kind(self) -> None:
        """A type's name."""
        self.name()
        while self.is_ident() and self.words[self.at] in ("precision", "varying", "time", "zone", "without", "unsigned"):
            self.at += 1
        if self.took("("):
            self.each(self.expression)
            self.need(")")

    def primary(self) -> None:
        if self.at >= len(self.words):
            raise ValueError(self.at)
        if self.kinds[self.at] in "sk":
            self.at += 1
        elif self.took("?"):
            pass
        elif self.took(":", "@"):
            self.ident()
        elif self.peek("("):
            if not self.took_query():
                self.row()
        elif self.took("case"):
            if not self.peek("when"):
                self.expression()
            self.need("when")
            self.at -= 1
            while self.took("when"):
                self.expression()
                self.need("then")
                self.expression()
            if self.took("else"):
                self.expression()
            self.need("end")
        elif self.phrase("cast", "("):
            self.expression()
            self.need("as")
            self.kind()
            self.need(")")
        elif self.took("exists"):
            self.bracketed()
        elif self.took("left", "right"):  # functions, too
            self.arguments()
        else:
            self.name()
            if self.peek("("):
                self.arguments()
            elif self.at < len(self.kinds) and self.kinds[self.at] == "s":  # date '...', interval '...'
                self.at += 1

    def arguments(self) -> None:
        self.need("(")
        if not self.took(")"):
            self.took("distinct")
            if self.peek("select", "with"):
                self.deeper(self.query)
            else:
                self.each(self.argument)
            if self.phrase("order", "by"):
                self.each(self.ordered)
            self.need(")")
        if self.phrase("filter", "("):
            self.need("where")
            self.expression()
            self.need(")")
        if self.took("over"):
            if self.peek("("):
                self.balanced(1)
            else:
                self.ident()

    def argument(self) -> None:
        if not self.took("*"):
            self.expression()
            if self.took("from", "as", "for"):  # extract(year from d) and the like
                self.expression()


def sql_valid_text(text: str) -> bool:
    """Whether the text is one or more statements of the subset of SQL that ``SqlSyntax`` reads."""
    try:
        return SqlSyntax(text).statements()
    except (ValueError, RecursionError):
        return False


@arrow_udf(BooleanType())
def syntax_valid(values: pa.Array) -> pa.Array:
    """Parses as Python without an error, or else as SQL."""
    return _parsed(values, lambda s: python_valid(s) or sql_valid_text(s), pa.bool_())


@arrow_udf(BooleanType())
def sql_valid(values: pa.Array) -> pa.Array:
    return _each(values, sql_valid_text, pa.bool_())


class _Shape(ast.NodeTransformer):
    """Every identifier under one name."""

    def visit(self, node):
        for field in ("id", "name", "arg", "attr", "module", "asname"):
            if isinstance(getattr(node, field, None), str):
                setattr(node, field, "VAR")
        if isinstance(node, (ast.Global, ast.Nonlocal)):
            node.names = ["VAR"] * len(node.names)
        return super().generic_visit(node)


def canonical(text: str) -> str:
    """The syntax tree with every identifier renamed, written out; the text itself if it can't be parsed."""
    try:
        return ast.dump(_Shape().visit(ast.parse(text)))
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return text


@arrow_udf(StringType())
def structure_hash(values: pa.Array) -> pa.Array:
    """SHA-256 of the canonical syntax tree; null for empty texts."""
    return _parsed(values, lambda s: hashlib.sha256(canonical(s).encode("utf-8", "replace")).hexdigest() if s else None, pa.string())


_LEAVES = (ast.Name, ast.Constant, ast.expr_context, ast.operator, ast.boolop, ast.cmpop, ast.unaryop)
_BRANCHES = (ast.If, ast.For, ast.AsyncFor, ast.While, ast.ExceptHandler, ast.IfExp, ast.Assert, ast.comprehension)


def complexity(text: str) -> int:
    """Cyclomatic complexity summed over functions and methods; 0 without any; 10 for blank text or what can't be parsed."""
    if not text.strip():
        return 10
    try:
        tree = ast.parse(text)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return 10

    # a branch counts for every function around it; one pass, whatever the nesting
    total, stack = 0, [(tree, 0)]
    while stack:
        node, around = stack.pop()
        if around:
            if isinstance(node, _BRANCHES):
                total += around
            if isinstance(node, ast.BoolOp):
                total += around * (len(node.values) - 1)
            elif isinstance(node, ast.comprehension):
                total += around * len(node.ifs)
            elif isinstance(node, ast.match_case):
                total += around
        if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
            total += 1
            around += 1
        for field in node._fields:
            value = getattr(node, field, None)
            if isinstance(value, ast.AST):
                if not isinstance(value, _LEAVES):
                    stack.append((value, around))
            elif isinstance(value, list):
                stack += [(x, around) for x in value if isinstance(x, ast.AST) and not isinstance(x, _LEAVES)]
    return total


@arrow_udf(IntegerType())
def cyclomatic(values: pa.Array) -> pa.Array:
    return _parsed(values, complexity, pa.int32())


def top_share(words: list[str], n: int, least: int) -> float:
    """The commonest n-gram's share of all n-grams; 0 with fewer than ``least`` words, or than n."""
    if len(words) < max(least, n):
        return 0.0
    return max(Counter(zip(*(words[i:] for i in range(n)))).values()) / (len(words) - n + 1)


def gram_share(lowered: Column, n: int, least: int) -> Column:
    """``top_share`` of lower-cased texts, split at white space of any script."""
    share, separators = top_share, re.compile("[\x1c-\x1f]")  # these are white space to Python's split, but not to Unicode
    words = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

    @arrow_udf(DoubleType())
    def of(values: pa.Array) -> pa.Array:
        return _each(values, lambda s: share(words.findall(s) if separators.search(s) else s.split(), n, least), pa.float64())

    return of.asNondeterministic()(lowered)  # it isn't, but a filter on its value must not compute it a second time


class Passages:
    """Texts, to tell whether another one shares a substring of a given length with any of them. Windows are compared by hash,
    64 bits of a polynomial read off prefix sums, and what meets is compared itself."""

    BASE, KEPT = 0x9E3779B97F4A7C15, 8

    def __init__(self, texts: list[str]):
        import numpy as np

        self.np, self.texts = np, [t for t in texts if t]
        self.known: dict[int, tuple] = {}

    def shares(self, text: str, k: int) -> bool:
        """Whether k characters in a row of ``text`` stand in one of the texts."""
        np = self.np
        if k <= 0:
            return True
        if k not in self.known:
            if len(self.known) >= self.KEPT:
                self.known.pop(next(iter(self.known)))
            rows = [self._scaled(t, k) for t in self.texts]
            self.known[k] = np.unique(np.concatenate(rows)) if rows else np.zeros(0, np.uint64)
        mine = self._scaled(text, k)
        hits = np.flatnonzero(np.isin(mine, self.known[k]))
        return any(any(text[i : i + k] in t for t in self.texts) for i in hits)

    def _scaled(self, text: str, k: int):
        """Windows' hashes that don't depend on where in a text they stand."""
        np = self.np
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        n = len(codes)
        if n < k:
            return np.zeros(0, np.uint64)
        inverse = np.uint64(pow(self.BASE, -1, 1 << 64))
        up, down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)])) for x in (np.uint64(self.BASE), inverse))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up[:-1])])
        return (sums[k:] - sums[:-k]) * down[: n - k + 1]


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full, row = (1 << len(a)) - 1, (1 << len(a)) - 1
    for c in b:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def minhashes(bags: list[list[str]], permutations: int, seed: int = 1):
    """Signatures of bags of strings, a row each: minima of universal hashes over a 61-bit prime, over a bounded number of words
    at once, of many small bags or of a part of a long one."""
    import numpy as np
    import xxhash

    prime, digest, most = np.uint64((1 << 61) - 1), xxhash.xxh32_intdigest, 1024
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 1 << 29, permutations, dtype=np.uint64)
    b = rng.integers(0, 1 << 60, permutations, dtype=np.uint64)

    def hashed(words):
        x = np.array([digest(w) for w in words], np.uint64)[:, None] * a + b
        x = (x & prime) + (x >> np.uint64(61))  # x was below 2^62, so this is the remainder, or over it by the prime
        return np.minimum(x, x - prime)

    out, i = np.empty((len(bags), permutations), np.uint64), 0
    while i < len(bags):
        words, starts, j = [], [], i
        while j < len(bags) and (j == i or len(words) + len(bags[j]) < most):
            starts.append(len(words))
            words += bags[j] or [""]
            j += 1
        if j == i + 1:
            out[i] = np.min([hashed(words[at : at + most]).min(axis=0) for at in range(0, len(words), most)], axis=0)
        else:
            out[i:j] = np.minimum.reduceat(hashed(words), starts, axis=0)
        i = j
    return out.astype(np.int64)


def minhash_rows(batches):
    """(doc_id, sig) of (doc_id, shingles), 128 permutations."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sigs = minhashes([v.as_py() or [] for v in part.column("shingles")], 128)
            sigs = pa.ListArray.from_arrays(pa.array(range(0, sigs.size + 1, 128), pa.int32()), pa.array(sigs.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), sigs], names=["doc_id", "sig"])
