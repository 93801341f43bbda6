"""Constants of instructions as tokens: ordered rules over what is known of an address, and which targets count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Kinds of addresses; fixed values of the format.
PLT, LOCAL, EXTERN, SYNTHETIC, STRING = "PLT_FUNCTION", "LOCAL_FUNCTION", "EXT_FUNCTION_REAL", "EXT_FUNCTION_SYNTHETIC", "STRING"
TABLE_SLOT, POINTER_SLOT, READ_ONLY, WRITABLE = "JUMP_TABLE_SLOT", "CODE_PTR_TABLE_SLOT", "RODATA", ["DATA", "BSS", "THREAD_LOCAL_DATA"]
#: Kinds whose targets always count; fixed values of the policy.
ANCHORS = [STRING, PLT, LOCAL, POINTER_SLOT]
#: Architecture -> mnemonics that end the building of an address from two halves; fixed values of the policy.
ENDS_ADDRESS = {"arm32": ["movt"], "aarch64": ["movk"], "mips": ["ori", "addi", "daddi"], "riscv": ["addi"], "ppc": ["ori", "addi"]}


def rules(c: Column) -> list[tuple[str, Column]]:
    """(name, condition) in order. c: a struct of value, is_arithmetic, fp_type, and of the address kind, start and is_vtable, null where nothing is known."""
    address = ~F.coalesce(c["is_arithmetic"], F.lit(False)) & c["kind"].isNotNull()
    entry = F.coalesce(c["value"] == c["start"], F.lit(False))
    return [
        ("float", c["fp_type"].isNotNull()),
        ("linked function", address & (c["kind"] == PLT)),
        ("local function", address & (c["kind"] == LOCAL) & entry),
        ("block", address & (c["kind"] == LOCAL)),
        ("external function", address & (c["kind"] == EXTERN)),
        ("synthetic function", address & (c["kind"] == SYNTHETIC)),
        ("string", address & (c["kind"] == STRING)),
        ("jump table slot", address & (c["kind"] == TABLE_SLOT)),
        ("pointer slot", address & ((c["kind"] == POINTER_SLOT) | F.coalesce(c["is_vtable"], F.lit(False)))),
        ("read-only data", address & (c["kind"] == READ_ONLY)),
        ("writable data", address & c["kind"].isin(WRITABLE)),
        ("value", F.lit(True)),
    ]


def first_match(ordered: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds; a condition that is null doesn't."""
    return F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in ordered])


def _token(name: str, number: Column | None = None) -> Column:
    return F.struct(F.lit(name).alias("token"), (F.lit(None) if number is None else number).cast("long").alias("number"))


def emitted(c: Column, rule: Column) -> Column:
    """Array of (token, number): the address that an identity stands for, a value's magnitude, or null.

    c also has tls, base and offset (of a jump table's slot), target_rule and target (an address) of a slot whose
    target is known, and fp_postfix, the type of float that is loaded from the address.
    """
    value = c["value"].cast("long")
    none = F.array().cast("array<struct<token:string,number:bigint>>")
    function = {"linked function": "PLT_FUNC", "local function": "LOCAL_FUNC", "block": "BLOCK", "external function": "EXT_FUNC", "synthetic function": "EXT_FUNC", "string": "STRING_PTR", "read-only data": "RO_DATA_PTR", "writable data": "RW_DATA_PTR"}

    def one(of: Column, number: Column) -> Column:
        return F.coalesce(*[F.when(of == name, F.array(_token(token, number))) for name, token in function.items()])

    table = F.coalesce(c["start"], value).cast("long")
    apart = F.array(_token("RO_DATA_PTR", table), _token("VALUED_CONST", value - table))
    slot = F.concat(F.array(F.when(F.coalesce(c["is_vtable"], F.lit(False)), _token("VTABLE")).otherwise(_token("CODE_PTR_TABLE"))), F.coalesce(one(c["target_rule"], c["target"].cast("long")), apart))
    local = F.when(F.coalesce(c["tls"], F.lit(False)), F.array(_token("THREAD_LOCAL"))).otherwise(none)
    plain = F.concat(F.array(_token("VALUED_CONST", F.abs(value))), F.when(value < 0, F.array(_token("VALUE_NEGATIVE"))).otherwise(none))
    tokens = (F.when(rule == "float", F.array(F.struct(F.concat(F.lit("FLOAT_"), c["fp_type"]).alias("token"), value.alias("number"))))
              .when(rule == "jump table slot", F.array(_token("JUMP_TABLE", c["base"]), _token("VALUED_CONST", c["offset"])))
              .when(rule == "pointer slot", slot).when(rule == "writable data", F.concat(local, one(rule, value))).when(rule == "value", plain).otherwise(one(rule, value)))
    loads = rule.isin("string", "jump table slot", "pointer slot", "read-only data", "writable data", "value") & c["fp_postfix"].isNotNull()
    return F.concat(tokens, F.when(loads, F.array(F.struct(F.concat(F.lit("FLOAT_"), c["fp_postfix"]).alias("token"), F.lit(None).cast("long").alias("number")))).otherwise(none))


def target_reason(kind: Column, target: Column, low: Column, high: Column, arch: Column, mnemonic: Column, has_load_store: Column) -> Column:
    """Why a target that analysis attached to a register counts; null: it doesn't. low and high: the function's bounds, both inside."""
    ends = F.coalesce(*[F.when((arch == a) & mnemonic.isin(names), F.lit(True)) for a, names in ENDS_ADDRESS.items()])
    return first_match([("anchor", kind.isin(ANCHORS)), ("own function", target.between(low, high)), ("memory access", has_load_store), ("address pair", ends)])
