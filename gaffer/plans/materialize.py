"""Model materialisation shared by the model classes.

``@mart`` turns a model method into a property that is built once per
session as a Parquet table under the shared checkpoint folder (SNK-3, the
reference's table materialisation) and read back, which also cuts lineage
for everything downstream. The owning class provides ``spark``,
``materialize`` (bool) and ``tag`` (a name unique to the instance's inputs), and may
provide ``WATCH`` (model -> columns whose nulls are counted as it is written).
"""

from __future__ import annotations

from gaffer.sources.landing import publish_once, published


# Set to a dict by tools/plan_report.py: the plan that each mart is built with.
PLANS: dict[str, str] | None = None


def mart(fn):
    name = fn.__name__

    def get(self):
        if name not in self.__dict__:
            key = f"{self.tag}/{name}"
            done = published(self.spark, key) if self.materialize else None
            if done is not None:
                self.__dict__[name] = done
            else:
                df = fn(self)
                if PLANS is not None:
                    PLANS[key] = df._jdf.queryExecution().executedPlan().toString()
                self.__dict__[name] = publish_once(self.spark, key, df, getattr(self, "WATCH", {}).get(name, ())) if self.materialize else df
        return self.__dict__[name]
    get.__doc__ = fn.__doc__
    return property(get)
