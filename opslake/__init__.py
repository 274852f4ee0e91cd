"""Operations analytics over a lakehouse, as PySpark DataFrame plans.

``sources``    typed readers, writers, file and catalog checks
``functions``  column expressions
``operators``  generic DataFrame operators (joins, sets, grids, runs, ranking)
``plans``      views, facts, knowledge graph, API rows, metrics, rules, changes, retrieval
``streaming``  the row-wise and tumbling-window rules on a streaming source
``workload``   every operator applied to the benchmark tables, with its SQL check
"""
