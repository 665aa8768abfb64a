from broadloom.plans.facts import PlanFacts, plan_facts
from broadloom.plans.sizing import SideSize, broadcast_checked, measure_side

__all__ = ["PlanFacts", "plan_facts", "SideSize", "broadcast_checked", "measure_side"]
