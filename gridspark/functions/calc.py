"""Map algebra: a whitelisted expression over bands A, B, ... compiled to Columns.

``&``, ``|``, ``^`` and ``~`` are bitwise on whole numbers and logical on comparisons, as in NumPy; ``not`` is logical.
Masked pixels are NULL and stay so.  Division, floor division and remainder by zero, and logarithms and roots outside
their domain, mask the pixel.  Comparisons count as 0 or 1 in arithmetic.  No text is ever executed.
"""

from __future__ import annotations

import ast
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stored type, bits and sign of the declared pixel types (fixed values).
DTYPES = {
    "boolean": ("uint8", 8, False), "uint8": ("uint8", 8, False), "int8": ("int8", 8, True), "uint16": ("uint16", 16, False), "int16": ("int16", 16, True),
    "uint32": ("uint32", 32, False), "int32": ("int32", 32, True), "float16": ("float16", None, True), "half": ("float16", None, True),
    "float32": ("float32", None, True), "single": ("float32", None, True), "float64": ("float64", None, True), "double": ("float64", None, True),
}


def band_names(n: int) -> list[str]:
    """A..Z, AA..ZZ, ..."""
    out = []
    for i in range(1, n + 1):
        name = ""
        while i:
            i, r = divmod(i - 1, 26)
            name = chr(65 + r) + name
        out.append(name)
    return out


def _number(c: Column, boolean: bool) -> Column:
    return c.cast("int") if boolean else c


class _Compiler(ast.NodeVisitor):
    """Columns with a mark that tells whether they are boolean."""

    def __init__(self, bands: Mapping[str, Column]):
        self.bands = bands

    def fail(self, node: ast.AST):
        raise ValueError(f"not allowed in a calculation: {ast.unparse(node)}")

    def generic_visit(self, node):
        self.fail(node)

    def value(self, node: ast.AST) -> Column:
        return _number(*self.visit(node))

    def truth(self, node: ast.AST) -> Column:
        c, boolean = self.visit(node)
        return c if boolean else c != 0

    def visit_Expression(self, node):
        return self.visit(node.body)

    def visit_Constant(self, node):
        if not isinstance(node.value, (int, float, bool)):
            self.fail(node)
        return F.lit(node.value), isinstance(node.value, bool)

    def visit_Name(self, node):
        if node.id not in self.bands:
            self.fail(node)
        return self.bands[node.id], False

    def visit_UnaryOp(self, node):
        match node.op:
            case ast.USub():
                return -self.value(node.operand), False
            case ast.UAdd():
                return self.value(node.operand), False
            case ast.Not():
                return ~self.truth(node.operand), True
            case ast.Invert():
                c, boolean = self.visit(node.operand)
                return (~c, True) if boolean else (F.bitwise_not(self.whole(c)), False)
        self.fail(node)

    def visit_BinOp(self, node):
        if isinstance(node.op, (ast.BitAnd, ast.BitOr, ast.BitXor)):
            (a, first), (b, second) = self.visit(node.left), self.visit(node.right)
            if first and second:
                return self.logical(a, b, node.op), True
            a, b = self.whole(_number(a, first)), self.whole(_number(b, second))
            return a.bitwiseAND(b) if isinstance(node.op, ast.BitAnd) else a.bitwiseOR(b) if isinstance(node.op, ast.BitOr) else a.bitwiseXOR(b), False
        a, b = self.value(node.left), self.value(node.right)
        match node.op:
            case ast.Add():
                return a + b, False
            case ast.Sub():
                return a - b, False
            case ast.Mult():
                return a * b, False
            case ast.Div():
                return F.when(b != 0, a.cast("double") / b), False
            case ast.FloorDiv():
                return F.when(b != 0, F.floor(a.cast("double") / b)), False
            case ast.Mod():
                return F.when(b != 0, a - F.floor(a.cast("double") / b) * b), False
            case ast.Pow():
                return F.pow(a, b), False
        self.fail(node)

    @staticmethod
    def whole(c: Column) -> Column:
        """For bits: a number that must be whole (one with a fraction is an error, as in NumPy)."""
        return F.when(c == F.floor(c), c.cast("long")).when(c.isNotNull(), F.raise_error(F.concat(F.lit("bits of a number that is not whole: "), c.cast("string"))).cast("long"))

    @staticmethod
    def logical(a: Column, b: Column, op: ast.operator) -> Column:
        """A masked operand masks the result."""
        both = a & b if isinstance(op, ast.BitAnd) else a | b if isinstance(op, ast.BitOr) else a != b
        return F.when(a.isNotNull() & b.isNotNull(), both)

    def visit_Compare(self, node):
        ops = {ast.Gt: "__gt__", ast.GtE: "__ge__", ast.Lt: "__lt__", ast.LtE: "__le__", ast.Eq: "__eq__", ast.NotEq: "__ne__"}
        if len(node.ops) != 1 or type(node.ops[0]) not in ops:
            self.fail(node)
        return getattr(self.value(node.left), ops[type(node.ops[0])])(self.value(node.comparators[0])), True

    def visit_Call(self, node):
        name = ast.unparse(node.func).removeprefix("np.").removeprefix("ma.")
        args = node.args
        one = {"abs": F.abs, "exp": F.exp, "floor": F.floor, "ceil": F.ceil}
        if node.keywords:
            self.fail(node)
        if name in one and len(args) == 1:
            return one[name](self.value(args[0])), False
        if name == "log" and len(args) == 1:
            return F.when((v := self.value(args[0])) > 0, F.log(v.cast("double"))), False
        if name == "sqrt" and len(args) == 1:
            return F.when((v := self.value(args[0])) >= 0, F.sqrt(v.cast("double"))), False
        if name == "where" and len(args) == 3:
            return F.when(c := self.truth(args[0]), self.value(args[1])).when(~c, self.value(args[2])), False
        if name in ("minimum", "maximum") and len(args) == 2:
            a, b = map(self.value, args)
            return F.when(a.isNotNull() & b.isNotNull(), (F.least if name == "minimum" else F.greatest)(a, b)), False
        if name == "clip" and len(args) == 3:
            v, low, high = map(self.value, args)
            return F.when(v.isNotNull(), F.least(F.greatest(v, low), high)), False
        if name == "isnan" and len(args) == 1:
            return F.isnan(self.value(args[0]).cast("double")), True
        if name in ("logical_and", "logical_or") and len(args) == 2:
            return self.logical(self.truth(args[0]), self.truth(args[1]), ast.BitAnd() if name == "logical_and" else ast.BitOr()), True
        if name == "logical_not" and len(args) == 1:
            return ~self.truth(args[0]), True
        if name == "masked_where" and len(args) == 2:
            return F.when(~self.truth(args[0]), self.value(args[1])), False
        self.fail(node)


def compile_calc(text: str, bands: Mapping[str, Column]) -> list[Column]:
    """One Column for each output band: several if the expression is np.ma.array([...]) or a list."""
    body = ast.parse(text.strip(), mode="eval").body
    if isinstance(body, ast.Call) and ast.unparse(body.func) in ("np.ma.array", "np.array") and len(body.args) == 1:
        body = body.args[0]
    compiler = _Compiler(bands)
    return [compiler.value(x) for x in (body.elts if isinstance(body, (ast.List, ast.Tuple)) else [body])]


def vector_calc(text: str | None, field: str) -> Column:
    """A vector layer's value: an SQL expression over the feature's columns, or the field itself, whatever its name."""
    return F.expr(text) if text else F.col("`" + field.replace("`", "``") + "`")


def fill_cast(value: Column, no_data: float | None, dtype: str) -> Column:
    """Masked pixels become no_data (if any), and numbers wrap into the type as C integers do."""
    _, bits, signed = DTYPES[dtype.lower()]
    filled = value if no_data is None else F.coalesce(value, F.lit(no_data))
    if bits is None:
        return filled.cast("double" if dtype in ("float64", "double") else "float")
    whole = F.when(filled >= 0, F.floor(filled)).otherwise(F.ceil(filled)).cast("long")
    wrapped = F.pmod(whole, F.lit(1 << bits))
    return F.when(wrapped >= 1 << (bits - 1), wrapped - (1 << bits)).otherwise(wrapped) if signed else wrapped
