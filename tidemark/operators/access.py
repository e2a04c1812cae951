"""Permissions, access decisions and resource policies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANY = "*"


@dataclass(frozen=True)
class Role:
    """Permissions are ``action:resource[:scope]`` texts."""

    name: str
    permissions: tuple[str, ...] = ()
    inherits: tuple[str, ...] = ()


# Roles present from the start.
DEFAULT_ROLES = (
    Role("admin", ("*:*",)),
    Role("reader", ("read:*", "list:*")),
    Role("writer", ("read:*", "list:*", "create:*", "update:*"), ("reader",)),
    Role("operator", ("read:*", "list:*", "execute:*")),
)


def role_permissions(roles: Sequence[Role]) -> dict[str, list[str]]:
    """All permissions of each role with those it inherits; cycles end."""
    named = {r.name: r for r in roles}
    out = {}
    for name in named:
        reached, waiting = set(), [name]
        while waiting:
            current = waiting.pop()
            if current in reached or current not in named:
                continue
            reached.add(current)
            waiting.extend(named[current].inherits)
        out[name] = sorted({p.lower() for r in reached for p in named[r].permissions})
    return out


def permission_parts(text: Column) -> list[Column]:
    """action, resource, scope of a permission text (scope may be null)."""
    parts = F.split(F.lower(text), ":")
    return [
        F.get(parts, 0).alias("action"),
        F.get(parts, 1).alias("resource"),
        F.nullif(F.get(parts, 2), F.lit("")).alias("scope"),
    ]


def effective_permissions(
    user_roles: DataFrame, roles: Sequence[Role] = DEFAULT_ROLES, direct: DataFrame | None = None
) -> DataFrame:
    """Distinct (user, permission): direct ones, those of roles, and inherited ones.

    Roles are configuration; ``user_roles`` (user, role) and ``direct``
    (user, permission) are tables. An unknown role gives nothing.
    """
    listed = F.create_map(
        *[
            part
            for name, permissions in role_permissions(roles).items()
            for part in (F.lit(name), F.array(*[F.lit(p) for p in permissions]).cast("array<string>"))
        ]
    )
    from_roles = user_roles.select("user", F.explode(listed[F.col("role")]).alias("permission"))
    if direct is not None:
        from_roles = from_roles.unionByName(direct.select("user", F.lower("permission").alias("permission")))
    return from_roles.distinct()


# Stands for "whatever the other side has" in lookup keys.
_WHATEVER = "\0any"


def _offers(part: Column) -> Column:
    """Keys a permission answers to: its own value, and requests that accept anything."""
    return F.array(F.coalesce(part, F.lit(ANY)), F.lit(_WHATEVER))


def _asks(part: Column) -> Column:
    """Keys a request looks up: its value or the wildcard, or anything."""
    open_end = part.isNull() | (part == ANY)
    return F.when(open_end, F.array(F.lit(_WHATEVER))).otherwise(F.array(part, F.lit(ANY)))


def evaluate_access(log: DataFrame, permissions: DataFrame, request: str = "request_id") -> DataFrame:
    """Add ``allowed`` to requests (user, action, resource, scope).

    A wildcard on either side matches; scope counts only when both have one. The
    wildcards become extra lookup keys (at most eight each), which turns the match
    into an equi-join that Spark can shuffle, broadcast or split by skew.
    """
    offered = (
        permissions.select("user", *permission_parts(F.col("permission")))
        .select("user", F.explode(_offers(F.col("action"))).alias("_a"), "resource", "scope")
        .select("user", "_a", F.explode(_offers(F.col("resource"))).alias("_r"), "scope")
        .select("user", "_a", "_r", F.explode(_offers(F.col("scope"))).alias("_s"))
        .distinct()
        .withColumn("_hit", F.lit(True))
    )
    asked = (
        log.select(request, "user", *[F.lower(c).alias(c) for c in ("action", "resource", "scope")])
        .select(request, "user", F.explode(_asks(F.col("action"))).alias("_a"), "resource", "scope")
        .select(request, "user", "_a", F.explode(_asks(F.col("resource"))).alias("_r"), "scope")
        .select(request, "user", "_a", "_r", F.explode(_asks(F.col("scope"))).alias("_s"))
    )
    hits = (
        asked.join(offered, ["user", "_a", "_r", "_s"])
        .groupBy(request)
        .agg(F.lit(True).alias("_allowed"))
    )
    return log.join(hits, request, "left").select(
        *log.columns, F.coalesce("_allowed", F.lit(False)).alias("allowed")
    )


@dataclass(frozen=True)
class Policy:
    """What may be done with a resource; ``*`` as resource covers every one."""

    resource: str
    allowed: tuple[str, ...] = ()
    denied: tuple[str, ...] = ()

    def permits(self, action: Column) -> Column:
        allowed = F.lit(True) if ANY in self.allowed else action.isin(*self.allowed)
        return ~action.isin(*self.denied) & allowed


def evaluate_policies(log: DataFrame, policies: Sequence[Policy]) -> DataFrame:
    """Add ``allowed``: all policies of the resource and of ``*`` must allow; none denies."""
    action, resource = F.col("action"), F.col("resource")
    by_resource: Mapping[str, list[Policy]] = {}
    for policy in policies:
        by_resource.setdefault(policy.resource, []).append(policy)
    general = by_resource.get(ANY, [])

    def all_of(chosen: Sequence[Policy]) -> Column:
        verdict = F.lit(bool(chosen))
        for policy in chosen:
            verdict = verdict & policy.permits(action)
        return verdict

    verdict = all_of(general)
    for name, chosen in by_resource.items():
        if name != ANY:
            verdict = F.when(resource == name, all_of([*chosen, *general])).otherwise(verdict)
    return log.withColumn("allowed", F.coalesce(verdict, F.lit(False)))
