"""Model constants, each a parameter with a default.

Fixed values below must equal the analysed application's choices for the
results to match; they are stated once, here, in natural order.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must match the analysed application) -------------------
VALID_EVENT_TYPES = ("view", "click", "add_to_cart", "bounce", "purchase")
CANONICAL_TRAFFIC_SOURCES = ("Organic", "Paid Search", "Social", "Email", "Direct")
FUNNEL_STEPS = ("view", "click", "add_to_cart", "purchase")
SESSION_GAP_MINUTES = 30
EXPERIMENT_GROUPS = ("Control", "Variant_A", "Variant_B")
N_BOOTSTRAP = 2000
BOOTSTRAP_SEED = 42
ALPHA = 0.05
BOUNCE = "bounce"
PURCHASE = "purchase"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Profile:
    """Everything that varies between the original dataset and the driver tables."""

    steps: tuple[str, ...] = FUNNEL_STEPS
    valid_event_types: tuple[str, ...] = VALID_EVENT_TYPES
    groups: tuple[str, ...] = EXPERIMENT_GROUPS
    gap_minutes: int = SESSION_GAP_MINUTES
    n_boot: int = N_BOOTSTRAP
    seed: int = BOOTSTRAP_SEED
    alpha: float = ALPHA
    expected_shares: tuple[float, ...] = (0.6, 0.2, 0.2)
    traffic_sources: tuple[str, ...] = CANONICAL_TRAFFIC_SOURCES

# The driver's event stream has types signup/view/click/purchase/error;
# FIXTURES.md §4 maps error -> bounce and uses these four steps.
DRIVER = Profile(steps=("signup", "view", "click", "purchase"),
                 valid_event_types=("signup", "view", "click", "bounce", "purchase"))
