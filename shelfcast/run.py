"""spark-submit entry: one preset, from a folder of input tables to a forecast.

    spark-submit -m shelfcast.run --preset boosted_sales_only --input DIR --output DIR
"""

import argparse

from shelfcast.plans.forecasts import run_preset
from shelfcast.plans.presets import PRESETS
from shelfcast.session import get_session
from shelfcast.sources.tables import read_model_tables, write_result


def main(argv=None):
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--preset", required=True, choices=sorted(PRESETS))
    parser.add_argument("--input", required=True, help="folder with the model tables")
    parser.add_argument("--output", required=True)
    parser.add_argument("--edition", action="append", default=[], help="more folders with sales")
    parser.add_argument("--input-format", default="csv")
    parser.add_argument("--output-format", default="csv")
    parser.add_argument(
        "--sorted", action="store_true", help="CSV files in the order of sku_id, one header"
    )
    parser.add_argument("--rounds", type=int, help="boosting rounds instead of the preset's")
    parser.add_argument(
        "--reverse-weeks", action="store_true", default=None, help="swap the weeks end to end"
    )
    args = parser.parse_args(argv)
    spark = get_session("shelfcast")
    tables = read_model_tables(
        spark,
        args.input,
        args.input_format,
        args.edition,
        price_mode=PRESETS[args.preset].price_mode,
    )
    forecast = run_preset(tables, args.preset, args.rounds, args.reverse_weeks)
    order = ["sku_id"] if args.sorted else []
    write_result(forecast, args.output, args.output_format, order=order)


if __name__ == "__main__":
    main()
