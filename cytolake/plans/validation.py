"""Validation of a changed step against a baseline: warm-ups, repeats, metrics, and a decision.

Each side is a function that runs the step and returns its metrics (numbers by name). Times are wall and CPU seconds of the
whole process group, so that JVM and Python workers count; memory is the largest resident set seen at the end of a run.
"""

from __future__ import annotations

import json
import resource
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from cytolake.operators.views import confidence95, one_sample_t, signed_rank

Step = Callable[[], dict[str, float]]


@dataclass
class Limits:
    """max_loss: how far a metric may fall below the baseline's, as a share; least_lower: what the lower end of the 95 % interval of
    the ratio must reach; least_gain: the share of the baseline's time that must be saved (none by default)."""

    max_loss: float = 0.005
    least_lower: float = 0.995
    least_gain: float | None = None


@dataclass
class Report:
    decision: str
    reasons: list[str]
    seconds: dict[str, tuple[float, float, float]]
    cpu_seconds: dict[str, float]
    peak_mb: float
    gain: float
    p_time: float
    metrics: dict[str, dict] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=1, sort_keys=True)


def _cpu() -> float:
    return sum(u.ru_utime + u.ru_stime for u in map(resource.getrusage, (resource.RUSAGE_SELF, resource.RUSAGE_CHILDREN)))


def measure(step: Step, warm_ups: int, repeats: int) -> tuple[list[float], float, list[dict[str, float]]]:
    """Wall seconds and metrics of each repeat, and mean CPU seconds."""
    for _ in range(warm_ups):
        step()
    wall, got, cpu = [], [], _cpu()
    for _ in range(repeats):
        t = time.perf_counter()
        got.append(step())
        wall.append(time.perf_counter() - t)
    return wall, (_cpu() - cpu) / max(repeats, 1), got


def validate(baseline: Step, candidate: Step, warm_ups: int = 1, repeats: int = 5, limits: Limits | None = None) -> Report:
    """PASS if every metric of the candidate holds up to the baseline's within the limits, else ROLLBACK_REQUIRED. A metric that the
    candidate lacks fails; larger is better. One repeat has no interval, so only the mean loss counts then."""
    limits = limits or Limits()
    base_s, base_cpu, base_m = measure(baseline, warm_ups, repeats)
    cand_s, cand_cpu, cand_m = measure(candidate, warm_ups, repeats)
    reasons, metrics = [], {}
    for name in sorted({k for m in base_m for k in m}):
        if any(name not in m for m in cand_m):
            reasons.append(f"{name}: missing")
            continue
        ratio = [c[name] / b[name] if b[name] else (1.0 if c[name] >= b[name] else 0.0) for b, c in zip(base_m, cand_m, strict=True)]
        mean, low, high = confidence95(ratio)
        metrics[name] = {"baseline": [m[name] for m in base_m], "candidate": [m[name] for m in cand_m], "ratio": mean, "low": low, "high": high, "p_loss": one_sample_t(ratio, 1.0)[1] if len(ratio) > 1 else 1.0}
        if mean < 1 - limits.max_loss:
            reasons.append(f"{name}: mean ratio {mean:.4f}")
        elif low == low and low < limits.least_lower:
            reasons.append(f"{name}: interval from {low:.4f}")
    gain = 1 - sum(cand_s) / sum(base_s) if sum(base_s) else 0.0
    if limits.least_gain is not None and gain < limits.least_gain:
        reasons.append(f"time: saved {gain:.3f}")
    peak = max(resource.getrusage(w).ru_maxrss for w in (resource.RUSAGE_SELF, resource.RUSAGE_CHILDREN)) / 1024
    seconds = {"baseline": confidence95(base_s), "candidate": confidence95(cand_s)}
    return Report("ROLLBACK_REQUIRED" if reasons else "PASS", reasons, seconds, {"baseline": base_cpu, "candidate": cand_cpu}, peak, gain, signed_rank(base_s, cand_s)[1], metrics)
