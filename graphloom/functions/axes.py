"""Build axes in names: instruction sets, compilers, versions, optimization levels."""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Instruction-set names and the platform each stands for; fixed values of the naming scheme.
PLATFORMS = {
    "x86": "x86", "i686": "x86", "i386": "x86", "x64": "x64", "x86_64": "x64", "amd64": "x64",
    "arm32": "arm32", "armv7l": "arm32", "armv7l-hf": "arm32", "armv6l": "arm32", "armhf": "arm32", "arm": "arm32", "arm64": "arm64", "aarch64": "arm64",
    "mips32": "mips32", "mips": "mips32", "mipsel": "mips32", "mips64": "mips64", "mips64el": "mips64",
    "ppc32": "ppc32", "ppc": "ppc32", "ppc64": "ppc64", "ppc64le": "ppc64", "riscv32": "riscv32", "riscv64": "riscv64",
}
#: Platform -> family and bits; fixed values.
FAMILIES = {"x86": ("x86", 32), "x64": ("x86", 64), "arm32": ("arm", 32), "arm64": ("arm", 64), "mips32": ("mips", 32), "mips64": ("mips", 64),
            "ppc32": ("ppc", 32), "ppc64": ("ppc", 64), "riscv32": ("riscv", 32), "riscv64": ("riscv", 64)}
#: Names under which variants of one instruction set are kept; others keep their own. Fixed values.
VARIANT_NAMES = {"x86_64": "x64", "amd64": "x64", "x64": "x64", "aarch64": "arm64", "arm64": "arm64"}


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])


def platform_of(arch: Column, strict: bool = True) -> Column:
    """Platform of an instruction-set name; an unknown one is an error, or null if not strict."""
    known = F.try_element_at(_map(PLATFORMS), arch)
    if not strict:
        return known
    return F.when(arch.isNotNull() & known.isNull(), F.raise_error(F.concat(F.lit("unknown arch "), arch)).cast("string")).otherwise(known)


def variant_arch(arch: Column) -> Column:
    return F.coalesce(F.try_element_at(_map(VARIANT_NAMES), arch), arch)


def family_of(platform: Column) -> Column:
    return F.try_element_at(_map({k: v[0] for k, v in FAMILIES.items()}), platform)


def bitness_of(platform: Column) -> Column:
    return F.try_element_at(_map({k: str(v[1]) for k, v in FAMILIES.items()}), platform).cast("int")


ISA = "|".join(sorted((re.escape(x) for x in PLATFORMS), key=lambda x: (-len(x), x)))


def parse_axes(name: Column) -> Column:
    """struct(program, isa_exact, isa_family, bitness, comp, comp_version, optim_level) of isa-comp-version-opt_program.

    The longest instruction set that begins the name counts; the version is all between compiler and
    level. Null axes where the name has no such form; the program is then what follows the first
    underscore, of the whole name or behind the instruction set.
    """
    isa = F.nullif(F.regexp_extract(name, f"^({ISA})-", 1), F.lit(""))
    rest = F.when(isa.isNull(), name).otherwise(F.substring(name, F.length(isa) + 2, F.length(name)))
    tail = F.substring_index(rest, "_", 1)
    program = F.when(F.contains(rest, F.lit("_")), F.substring(rest, F.length(tail) + 2, F.length(rest)))
    parts = F.split(tail, "-", -1)
    ok = isa.isNotNull() & (F.size(parts) >= 3)
    platform = platform_of(isa, strict=False)

    def only(x: Column) -> Column:
        return F.when(ok, x)

    return F.struct(program.alias("program"), only(isa).alias("isa_exact"), only(family_of(platform)).alias("isa_family"), only(bitness_of(platform)).alias("bitness"),
                    only(F.get(parts, F.lit(0))).alias("comp"), only(F.array_join(F.slice(parts, F.lit(2), F.size(parts) - 2), "-")).alias("comp_version"),
                    only(F.element_at(parts, -1)).alias("optim_level"))


def output_basename(arch: Column, compiler: Column, version: Column, opt: Column, pkg: Column, variant_id: Column) -> Column:
    """arch-compiler-version-opt_pkg, and __ with eight hex digits for a variant other than 0."""
    base = F.concat(F.concat_ws("-", arch, compiler, version, opt), F.lit("_"), pkg)
    return F.when(variant_id == 0, base).otherwise(F.concat(base, F.lit("__"), F.lower(F.lpad(F.hex(variant_id), 8, "0"))))


def split_variant_id(name: Column) -> Column:
    """struct(pkg, variant_id) of a name that may end in __ and eight hex digits."""
    found = F.nullif(F.regexp_extract(name, "__([0-9a-f]{8})$", 1), F.lit(""))
    return F.struct(F.when(found.isNull(), name).otherwise(F.regexp_replace(name, "__[0-9a-f]{8}$", "")).alias("pkg"), F.coalesce(F.conv(found, 16, 10).cast("long"), F.lit(0)).alias("variant_id"))


def axis_tokens(arch: Column, compiler: Column, version: Column, opt: Column, extra: Column) -> Column:
    """Tokens of a variant: arch, comp, cver and opt, then key:value of the extra map, keys and values sorted."""
    four = F.array(F.concat(F.lit("arch:"), arch), F.concat(F.lit("comp:"), compiler), F.concat(F.lit("cver:"), compiler, F.lit(":"), version), F.concat(F.lit("opt:"), F.regexp_replace(opt, "^-", "")))
    entries = F.array_sort(F.map_entries(F.coalesce(extra, F.create_map().cast("map<string,array<string>>"))))
    return F.concat(four, F.flatten(F.transform(entries, lambda e: F.transform(F.array_sort(e["value"]), lambda v: F.concat(e["key"], F.lit(":"), v)))))


def strip_axis(token: Column) -> Column:
    """Value of an axis token, without its prefix."""
    return F.regexp_replace(token, "^(cver:[^:]*:|[^:]*:)", "")


def normalize_opt(level: Column, pattern: str = "[oO]([0123s])") -> Column:
    """O and the captured level of a value that matches as a whole; other values stay."""
    found = F.regexp_extract(level, f"^(?:{pattern})$", 1 if "(" in pattern else 0)
    return F.when(found == "", level).otherwise(F.concat(F.lit("O"), found) if "(" in pattern else found)


#: Field -> its regex; a template names each once at least.
FIELDS = {"platform": "[^-_]+(?:-hf)?", "compiler": "[^-_]+", "version": "[^-_]+", "optimisationlevel": "[oO]?[0-3sz]", "binaryname": ".+"}


def template_regex(template: str, fields: dict[str, str] | None = None) -> tuple[str, dict[str, int]]:
    """Anchored regex of a name template, and the group of each field; a repeated field must repeat its value."""
    own = FIELDS | (fields or {})
    out, groups, at = "^", {}, 0
    for found in re.finditer("|".join(sorted(own, key=len, reverse=True)), template):
        out += re.escape(template[at : found.start()])
        name = found[0]
        if name in groups:
            out += f"\\{groups[name]}"
        else:
            groups[name] = len(groups) + 1
            out += f"({own[name]})"
        at = found.end()
    if missing := own.keys() - groups.keys():
        raise ValueError(f"template lacks {sorted(missing)}")
    return out + re.escape(template[at:]) + "$", groups


def parse_template(name: Column, template: str, fields: dict[str, str] | None = None) -> Column:
    """struct of the template's fields, null where the name doesn't match."""
    regex, groups = template_regex(template, fields)
    return F.when(name.rlike(regex), F.struct(*[F.regexp_extract(name, regex, g).alias(f) for f, g in groups.items()]))


def selected(parsed: Column, allowed: dict[str, list[str]]) -> Column:
    """Whether all listed fields of a parsed name have allowed values."""
    out = parsed.isNotNull()
    for field, values in allowed.items():
        out = out & parsed[field].isin(values)
    return out


def outside_folders(path: Column, excluded: list[str]) -> Column:
    """Whether a relative path contains none of the excluded folders."""
    return ~path.rlike("|".join(excluded)) if excluded else F.lit(True)


def is_elf(content: Column, name: Column) -> Column:
    return (F.hex(F.substring(content, 1, 4)) == "7F454C46") & ~F.endswith(name, F.lit(".debug"))


# What a tool's output holds, and the name that stands for it, first match first.
ARCHITECTURES = [("x86-64", "x86_64"), ("ARM", "ARM"), ("aarch64", "ARM64")]
COMPILERS = [("GCC:", "GCC"), ("clang", "Clang"), ("Microsoft", "MSVC")]
LEVELS = "-O[0123s]"
UNKNOWN = "Unknown"


def named_by(text: Column, marks: list[tuple[str, str]]) -> Column:
    """The name of the first mark in the list that the text holds."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(mark)), F.lit(name)) for mark, name in marks], F.lit(UNKNOWN))


def toolchain(file_output: Column, strings_output: Column) -> Column:
    """struct(architecture, compiler, optimization) guessed from the output of file and strings."""
    level = F.coalesce(F.nullif(F.regexp_extract(strings_output, LEVELS, 0), F.lit("")), F.lit(UNKNOWN))
    return F.struct(named_by(file_output, ARCHITECTURES).alias("architecture"), named_by(strings_output, COMPILERS).alias("compiler"), level.alias("optimization"))
