"""Queries over the given tables, by group."""

from quire.plans import layout_plans, links_plans, records_plans, sequence_plans, text_plans

GROUPS = [text_plans.plans, layout_plans.plans, links_plans.plans, sequence_plans.plans, records_plans.plans]
