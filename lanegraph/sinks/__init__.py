"""Writers and readers of results: tables, summary document, graph, models, marts."""
