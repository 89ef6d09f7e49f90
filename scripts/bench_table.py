
import json
import sys

d = json.loads(open(sys.argv[1]).read().strip().splitlines()[-1])
print(f"Total {d['value']} s over {d['n_queries']} queries, sf {d['sf']}, local[{d['cpus']}].\n")
print("| query | seconds |")
print("|---|---|")
for k, v in d["queries"].items():
    print(f"| {k} | {v} |")
