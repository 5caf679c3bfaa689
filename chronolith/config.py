"""Descriptors, rights and approvals: documents with closed key sets."""

from __future__ import annotations

import hashlib
import hmac
import json
from collections.abc import Callable
from typing import Any, NamedTuple

from chronolith.identity import canonical_json

# fixed values: states and operations of a rights record
RIGHTS_STATES = ("ALLOWED", "OWNER_APPROVED_PENDING_COUNSEL", "PROHIBITED", "UNKNOWN")
INTERNAL_OPERATIONS = ("acquire_internal", "retain_raw_internal", "normalize_internal", "analyze_internal", "model_train_internal")
OTHER_OPERATIONS = ("commercial_production_eligible", "customer_display", "raw_redistribution")


class ConfigError(ValueError):
    pass


def _unique(pairs: list[tuple[str, Any]]) -> dict:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise ConfigError("a key stands twice")
    return out


def parse_document(text: str) -> dict:
    """A JSON document, or YAML where a YAML reader is installed; a key that
    stands twice and YAML merge keys are refused."""
    if text.lstrip().startswith("{"):
        out = json.loads(text, object_pairs_hook=_unique, parse_float=lambda x: (_ for _ in ()).throw(ConfigError(f"binary float {x}")))
    else:
        try:
            import yaml
        except ImportError as error:
            raise ConfigError("no YAML reader is installed; give JSON") from error

        class Strict(yaml.SafeLoader):
            pass

        def mapping(loader, node):
            if any(k.tag == "tag:yaml.org,2002:merge" for k, _ in node.value):
                raise ConfigError("merge keys are not permitted")
            return _unique([(loader.construct_object(k, deep=True), loader.construct_object(v, deep=True)) for k, v in node.value])

        Strict.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, mapping)
        out = yaml.load(text, Strict)
    if not isinstance(out, dict):
        raise ConfigError("the document is no mapping")
    return out


class Shape(NamedTuple):
    """Exact keys of a mapping: each a value to equal, a predicate, or a Shape."""

    keys: dict[str, Any]

    def check(self, value: Any, at: str = "$") -> None:
        if not isinstance(value, dict):
            raise ConfigError(f"{at} is no mapping")
        if value.keys() != self.keys.keys():
            raise ConfigError(f"{at} has keys {sorted(value)}, not {sorted(self.keys)}")
        for k, rule in self.keys.items():
            if isinstance(rule, Shape):
                rule.check(value[k], f"{at}.{k}")
            elif callable(rule):
                if not rule(value[k]):
                    raise ConfigError(f"{at}.{k} is not permitted: {value[k]!r}")
            elif value[k] != rule or type(value[k]) is not type(rule):
                raise ConfigError(f"{at}.{k} must be {rule!r}")


def text(value: Any) -> bool:
    return isinstance(value, str) and bool(value)


def sha256_text(value: Any) -> bool:
    return isinstance(value, str) and len(value) == 64 and set(value) <= set("0123456789abcdef")


_STATE = Shape({"state": lambda v: v in RIGHTS_STATES, "source_terms": text, "review_date": text, "reviewer": text, "rationale": text})
RIGHTS = Shape({"schema": text, "record_id": text, "provider": text, "reviewer": text, "review_date": text, "operations": Shape({o: _STATE for o in (*INTERNAL_OPERATIONS, *OTHER_OPERATIONS)})})
APPROVAL = Shape({"schema": text, "dataset": text, "quality_identity_sha256": sha256_text, "approver": text, "decision_time_utc": text, "findings": lambda v: isinstance(v, list) and all(isinstance(f, dict) and f.keys() == {"check_id", "count", "digest"} for f in v)})
RESEARCH = Shape({"schema": text, "parent": text, "roc_lookback": 60, "vol_lookback": 20, "volume_lookback": 20, "horizon": 24})
FOLDS = Shape({"schema": text, "parent": text, "test_rows": 72, "minimum_train_rows": 336, "embargo_rows": 24})
EVALUATION = Shape({"schema": text, "parents": lambda v: isinstance(v, list) and all(map(text, v)), "metrics": lambda v: v == ["pearson_ic", "spearman_ic"]})
TRAINING = Shape({"schema": text, "parents": lambda v: isinstance(v, list) and all(map(text, v)), "family": lambda v: v in ("ridge", "logistic_irls"), "lambda": "1"})


def permits(rights: dict, operation: str) -> bool:
    """Internal operations may run on owner approval; others only if allowed."""
    RIGHTS.check(rights)
    state = rights["operations"][operation]["state"]
    return state == "ALLOWED" or (operation in INTERNAL_OPERATIONS and state == "OWNER_APPROVED_PENDING_COUNSEL")


def semantic_hash(document: dict) -> str:
    return hashlib.sha256(canonical_json(document)).hexdigest()


def require_pinned(document: dict, digest: str) -> None:
    if semantic_hash(document) != digest:
        raise ConfigError("the protocol is not the pinned one")


def sealed_year_permitted(key: bytes, protocol_digest: str, year: int, token: str) -> bool:
    """Whether ``token`` opens a sealed year under this very protocol."""
    want = hmac.new(key, f"{protocol_digest}|{year}".encode(), hashlib.sha256).hexdigest()
    return hmac.compare_digest(want, token)


def dispatch(document: dict, lanes: dict[str, Callable[[dict], int]]) -> int:
    """Run the lane that a descriptor's schema names."""
    lane = lanes.get(document.get("schema", ""))
    if lane is None:
        raise ConfigError(f"no lane for schema {document.get('schema')!r}")
    return lane(document)
