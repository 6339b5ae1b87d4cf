"""The declared datasets register with the pipelines API and compute the layers."""

from ridewx.plans import declared
from ridewx.plans.catalog import Inputs

from tests.conftest import SF_SMALL


def test_declared_layers_register_and_run(spark):
    from pyspark.pipelines.graph_element_registry import (
        GraphElementRegistry,
        graph_element_registration_context,
    )

    class Capture(GraphElementRegistry):
        def __init__(self):
            self.outputs, self.flows = [], []

        def register_output(self, output):
            self.outputs.append(output)

        def register_flow(self, flow):
            self.flows.append(flow)

        def register_sql(self, sql_text, file_path):
            raise AssertionError("no SQL definitions expected")

    reg = Capture()
    with graph_element_registration_context(reg):
        declared.declare()
    names = [o.name for o in reg.outputs]
    assert names == [declared.BRONZE, declared.SILVER, *declared.GOLD]
    assert [f.target for f in reg.flows] == names

    # Run the flows in declaration order against this session's tables.
    i = Inputs(spark, SF_SMALL)
    i.weather_raw.createOrReplaceTempView(declared.STAGED_OBSERVATIONS)
    i.trips.createOrReplaceTempView(declared.TRIPS)
    for flow in reg.flows:
        flow.func().createOrReplaceTempView(flow.target)
    assert spark.table(declared.SILVER).count() == 726
    assert sum(r.trip_count for r in spark.table("weather_impact_summary").collect()) == 726
