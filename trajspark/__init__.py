"""Movement trajectories as Spark DataFrames: relocations, steps, parameters, summaries, lines and windows."""
