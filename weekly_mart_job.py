"""Command line of the jobs, for spark-submit.

    spark-submit weekly_mart_job.py -p '{"name": ..., "input_path": {...}, ...}'
    spark-submit weekly_mart_job.py load -p '{"name": ..., "staged": {...}, "database": ...}'
    spark-submit weekly_mart_job.py export -p '{"name": ..., "database": ..., "location": ...}'
    spark-submit weekly_mart_job.py update -p {old_input_path, input_path, output_path, ...}
    spark-submit weekly_mart_job.py run-if-ready -p '{"name": ..., "location": ...,
                                                      "output_path": ..., "partition_column": ...}'
"""

import argparse

from stockweek.plans.commands import COMMANDS, run_command

if __name__ == "__main__":
    parser = argparse.ArgumentParser(description="Run a job on Spark.")
    parser.add_argument("command", nargs="?", choices=list(COMMANDS), default="mart")
    parser.add_argument("-p", "--params", required=True, help="job parameters as JSON")
    given = parser.parse_args()
    print(*run_command(given.command, given.params), sep="\n")
