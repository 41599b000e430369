"""tickfold: hourly VWAP, company/index enrichment and calendar rollups of
trade data, as Spark DataFrame plans.

Layers: ``sources`` (bronze inputs) -> ``operators`` (explode, hourly VWAP,
index alignment, joins, rollups, preview) -> ``plans`` (silver, gold, the whole
run) -> ``sinks`` (CSV).  ``functions`` holds the column expressions they share.


    from tickfold.plans import gold, medallion, silver
    core = silver.core(trades, market_index)            # hourly VWAP joined to the index
    hourly = silver.report(core, companies, round_decimals=2)
    monthly = gold.rollup(core, companies, "month")
    medallion.run(spark, inputs, "/shared/reports")     # everything, written as CSV

or, with the reference's method names, ``tickfold.api.TradeProcessor``.
"""

__version__ = "0.1.0"
