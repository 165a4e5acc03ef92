"""Equivalent SQL for the registered queries, written from the definitions in plain form for a second engine."""

from __future__ import annotations

from zlib import crc32

from ledgerlens import schema
from ledgerlens.plans.fixture import transactions_sql
from ledgerlens.plans.queries import LIMITS, TRIAL_SCALES

F = schema.FEATURES


def _num(x: float) -> str:
    return f"{float(x):.17e}"


def _with(*parts: str, select: str) -> str:
    return "with " + ",\n".join(parts) + "\n" + select


def _tx(limit: int = 150) -> str:
    return f"tx as ({transactions_sql('events', limit)})"


def _hash(key: str, copy: str = "0", purpose: str = "", seed: int = 42) -> str:
    prime = 2147483647
    base = (f"((({key} & {prime}) * 902433191 + ({key} >> 31) * 1048573 + {copy} * 715827883"
            f" + {crc32(f'{purpose}|{seed}'.encode()) % prime}) % {prime})")
    first = f"((xor({base}, {base} >> 15) * 1597334677) % {prime})"
    return f"((xor({first}, {first} >> 13) * 747796405) % {prime})"


TX = _tx()
KEPT = "kept as (select * from tx where type in ('CASH_OUT', 'TRANSFER'))"
STATS = """stats as (select quantile_cont(a, 0.01) as p1, quantile_cont(a, 0.05) as p5, quantile_cont(a, 0.25) as p25,
    quantile_cont(a, 0.5) as median, quantile_cont(a, 0.75) as p75, quantile_cont(a, 0.95) as p95,
    quantile_cont(a, 0.99) as p99, avg(a) as mean, stddev_pop(a) as std
    from (select cast(amount as double) as a from kept))"""
WIDE = """wide as (
    select *, amount_log * hour as amount_hour_interaction, is_round_amount * is_night as round_amount_night,
           is_extreme_amount * is_cash_out as extreme_amount_cashout,
           case when is_round_amount = 1 and amount >= 100000 and is_night = 1 then 1 else 0 end as high_risk_pattern,
           case when is_deep_night = 1 or is_weekend = 1 then 1 else 0 end as suspicious_timing
    from (select *, case when hour >= 22 or hour <= 6 then 1 else 0 end as is_night,
                 case when day % 7 >= 5 then 1 else 0 end as is_weekend,
                 case when hour >= 1 and hour <= 4 then 1 else 0 end as is_deep_night
          from (select tx_id, step, kept.type, amount, isFraud, ln(1 + cast(amount as double)) as amount_log,
                       (cast(amount as double) - stats.mean) / stats.std as amount_zscore,
                       case when cast(amount as double) % 1000 = 0 then 1 else 0 end as is_round_amount,
                       case when amount >= stats.p99 or amount <= stats.p1 then 1 else 0 end as is_extreme_amount,
                       case when amount > 0 and amount <= 1000 then 0 when amount > 1000 and amount <= 10000 then 1
                            when amount > 10000 and amount <= 100000 then 2
                            when amount > 100000 and amount <= 1000000 then 3
                            when amount > 1000000 then 4 end as amount_category,
                       step % 24 as hour, step // 24 + 1 as day, codes.code as type_encoded,
                       case when kept.type = 'CASH_OUT' then 1 else 0 end as is_cash_out
                from kept cross join stats
                join (select type, dense_rank() over (order by type) - 1 as code
                      from (select distinct type from kept)) codes on codes.type = kept.type)))"""
FEATS = ("feats as (select tx_id, " + ", ".join(f"cast({f} as float) as {f}" for f in F) + ", isFraud from wide)")
BASE = [TX, KEPT, STATS, WIDE, FEATS]


def _base(limit: int) -> list[str]:
    return [_tx(limit), *BASE[1:]]


SCORED = """scored as (select tx_id, isFraud as label,
    round(cast(amount as double) / (cast(amount as double) + 300000), 6) as p from kept)"""


def _sizes(source: str, nested: bool = True) -> list[str]:
    """Class sizes of the held-out parts: ceil(0.2 n) in all, shared by proportion with largest remainder."""
    def held(name: str, prior: str, rows: str, out: str) -> str:
        return f"""{name} as (select *, {rows} - (base + case when place <= keep - sum(base) over () then 1 else 0 end) as {out}
            from (select *, row_number() over (order by rest desc, label) as place
                  from (select *, (cast(keep as hugeint) * {rows}) // total as base, (cast(keep as hugeint) * {rows}) % total as rest
                        from (select *, total - cast(ceil(cast(0.2 as double) * total) as bigint) as keep
                              from (select *, cast(sum({rows}) over () as bigint) as total from {prior})))))"""
    parts = [f"counts as (select isFraud as label, count(*) as n from {source} group by 1)",
             held("s1", "counts", "n", "n_test"),
             "s2 as (select label, n, cast(n_test as bigint) as n_test, cast(n - n_test as bigint) as left_over from s1)"]
    return parts + [held("s3", "s2", "left_over", "n_val")]


def _split(source: str = "feats") -> list[str]:
    return [*_sizes(source), f"""splits as (select {source}.*, case when pos.rn <= n_test then 'test' when pos.rn <= n_test + n_val then 'val'
            else 'train' end as split
        from {source} join (select tx_id, row_number() over (partition by isFraud order by {_hash('tx_id')}, tx_id) as rn
                         from {source}) pos using (tx_id) join s3 on s3.label = {source}.isFraud)""",
            f"train as (select * exclude (split) from splits where split = 'train')"]


def _vec(alias: str, f: str) -> str:
    return f"coalesce(cast({alias}.{f} as double), -1)"


D2 = " + ".join(f"({_vec('q', f)} - {_vec('p', f)}) * ({_vec('q', f)} - {_vec('p', f)})" for f in F)


def _near(name: str, queries: str, points: str, k: int) -> str:
    return f"""{name} as (select * from (
        select q_id, nn_id, nn_label, d2, row_number() over (partition by q_id order by d2, nn_id) as rank
        from (select q.tx_id as q_id, p.tx_id as nn_id, p.isFraud as nn_label, {D2} as d2
              from {queries} q join {points} p on p.tx_id <> q.tx_id)) where rank <= {k})"""


MINORITY = "minority as (select * from train where isFraud = 1)"


def _need(target: float) -> str:
    return (f"need as (select cast(trunc({_num(target)} * count(*) filter (where isFraud = 0) "
            "- count(*) filter (where isFraud = 1)) as bigint) as n_new from train)")


def _even(seeds: str) -> str:
    return f"""copies as (select s.tx_id, n_new // m + case when row_number() over (order by {_hash('s.tx_id', purpose='copies')}, s.tx_id)
        <= n_new % m then 1 else 0 end as copies from {seeds} s, need, (select count(*) as m from {seeds}) n)"""


def _synthetic(k: int) -> str:
    return f"""synthetic as (select -(before + copy) as tx_id, {', '.join(
        f"cast({_vec('s', f)} + gap * ({_vec('w', f)} - {_vec('s', f)}) as float) as {f}" for f in F)}, 1 as isFraud
        from (select c.tx_id as id, copy, before, {_hash('c.tx_id', 'copy', 'pick')} % {k} + 1 as pick,
                     {_hash('c.tx_id', 'copy', 'gap')} / 2147483647.0::double as gap
              from (select *, cast(sum(copies) over (order by tx_id) - copies as bigint) as before from copies) c,
                   lateral (select unnest(generate_series(1, c.copies)) as copy))
        join minority s on s.tx_id = id join nn on nn.q_id = id and nn.rank = pick
        join (select tx_id as w_id, {', '.join(F)} from minority) w on w.w_id = nn.nn_id)"""


def _round(columns: list[str], digits: int) -> str:
    return ", ".join(f"round(cast({c} as double), {digits}) as {c}" for c in columns)


SYNTHETIC_OUT = f"select tx_id, {_round(F, 3)}, isFraud from synthetic"


def _smote(limit: int, target: float, k: int) -> list[str]:
    return [*_base(limit), *_split(), MINORITY, _need(target), _near("nn", "minority", "minority", k),
            _even("minority"), _synthetic(k)]


# Grids, ranges and fixed parameters, stated again like the rules below: (first, last, number) of thresholds.
GRIDS = {"device": (0.01, 0.99, 200), "host": (0.05, 0.95, 100), "search": (0.05, 0.95, 100), "curve": (0.1, 0.9, 50)}
DRAWN = [("max_depth", "int", 2, 6), ("learning_rate", "log", 0.01, 0.1), ("n_estimators", "int", 200, 800),
         ("subsample", "uniform", 0.6, 0.95), ("colsample_bytree", "uniform", 0.6, 0.95), ("min_child_weight", "int", 1, 10),
         ("gamma", "uniform", 0.0, 0.8), ("reg_alpha", "uniform", 0.0, 1.0), ("reg_lambda", "uniform", 0.0, 1.0)]
DRAWN_WIDE = [("max_bin", "int", 512, 2048), ("max_depth", "int", 3, 8), ("learning_rate", "log", 0.005, 0.15),
              ("n_estimators", "int", 300, 1500), ("subsample", "uniform", 0.5, 0.95), ("colsample_bytree", "uniform", 0.5, 0.95),
              ("colsample_bylevel", "uniform", 0.5, 1.0), ("min_child_weight", "int", 1, 15), ("gamma", "uniform", 0.0, 1.0),
              ("reg_alpha", "uniform", 0.0, 2.0), ("reg_lambda", "uniform", 0.0, 2.0), ("lossguide", "int", 0, 1),
              ("max_leaves", "int", 0, 1024)]
FIXED = {"max_depth": 5, "learning_rate": 0.03, "n_estimators": 800, "subsample": 0.8, "colsample_bytree": 0.8,
         "min_child_weight": 3, "gamma": 0.1, "reg_alpha": 0.1, "reg_lambda": 0.1}


def _grid(grid: tuple[float, float, int]) -> str:
    low, high, n = grid
    return (f"grid as (select case when i = {n - 1} then {_num(high)} else i * {_num((high - low) / (n - 1))} + {_num(low)} end "
            f"as threshold from range({n}) t(i))")


def _sweep(grid: tuple[float, float, int], scored: str = "scored", by: str = "") -> list[str]:
    key = f"{by}, " if by else ""
    return [_grid(grid), f"""counts_at as (select {key}threshold,
        count(*) filter (where label = 1 and p >= threshold) as tp, count(*) filter (where label = 0 and p >= threshold) as fp,
        count(*) filter (where label = 1 and p < threshold) as fn, count(*) filter (where label = 0 and p < threshold) as tn
        from {scored} cross join grid group by {key}threshold)""",
            """sweep as (select *, case when tp + fp = 0 then 0 else tp / (tp + fp) end as precision,
        case when tp + fn = 0 then 0 else tp / (tp + fn) end as recall,
        case when 2 * tp + fp + fn = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end as f1,
        case when fp + tn = 0 then 1 else fp / (fp + tn) end as fpr from counts_at)"""]


# The rules of the three presets, stated again so that the check does not read the code it checks.
RULES = {"device": ("recall >= 0.45 and fpr <= 0.05 and precision >= 0.3", "2 * precision + 0.8 * recall + 0.6 * f1 - 3 * fpr"),
         "host": ("recall >= 0.45 and fpr <= 0.05", "2 * precision + 0.5 * recall + 0.3 * f1 - 2 * fpr"),
         "search": ("recall >= 0.45 and fpr <= 0.05 and precision >= 0.3",
                    "2 * precision + least(0.5 * recall, 0.3) + 0.3 * f1 - greatest(0, 5 * (fpr - 0.02))")}


def _valid(preset: str, scored: str = "scored", by: str = "") -> list[str]:
    limits, score = RULES[preset]
    return [*_sweep(GRIDS[preset], scored, by),
            f"valid as (select *, {score} as score from sweep where tp + fp > 0 and {limits})"]


def _chosen(preset: str) -> list[str]:
    return [TX, KEPT, SCORED, *_valid(preset), "chosen as (select * from valid order by score desc, threshold limit 1)"]


RATES = ["precision", "recall", "f1", "fpr"]
POINTS = """points as (select p, sum(pos) over w as c_pos, sum(neg) over w as c_neg, pos, neg, sum(pos) over () as p_all, sum(neg) over () as n_all
    from (select p, count(*) filter (where label = 1) as pos, count(*) filter (where label = 0) as neg from scored group by p)
    window w as (order by p desc))"""
AUC = "sum(neg * (c_pos - pos / 2)) / (max(p_all) * max(n_all))"
AP = "sum(pos * c_pos / (c_pos + c_neg)) / max(p_all)"
METRICS = [*_chosen("device"), POINTS, f"""m as (select tp, fp, fn, tn, precision, recall, f1, precision as investigation_efficiency,
    recall as fraud_detection_rate, fpr, tn / (tn + fp) as specificity, tn / (tn + fn) as negative_predictive_value,
    (select {AUC} from points) as auc_roc, (select {AP} from points) as auc_pr, threshold from chosen)"""]


def _unpivot(names: dict[str, str]) -> str:
    return " union all ".join(f"select '{m}' as metric, cast({c} as double) as value from m" for m, c in names.items())


TARGETS = "targets(metric, low, high) as (values ('precision', 0.30, 0.55), ('recall', 0.45, 0.70), ('f1', 0.35, 0.55), ('auc_roc', 0.70, 0.85), ('fpr', 0.0, 0.05))"
GRADES = [TARGETS, f"""grades as (select metric, value, cast(low as double) as low, cast(high as double) as high, value <= high as within_limit,
    case when value >= low and value <= high then 'EXCELLENT' when value >= low then 'GOOD' else 'NEEDS_WORK' end as grade,
    case when value >= low and value <= high then 1.0 when value >= low then 0.5 else 0.0 end as points
    from ({_unpivot({m: m for m in ('precision', 'recall', 'f1', 'auc_roc', 'fpr')})}) join targets using (metric))"""]
EARLIER = "earlier(metric, baseline) as (values ('precision', 0.1487), ('recall', 0.5298), ('f1', 0.2322), ('auc_roc', 0.8595))"
CHANGE = [EARLIER, f"""change as (select metric, value, cast(baseline as double) as baseline, (value / cast(baseline as double) - 1) * 100 as change_percent
    from ({_unpivot({m: m for m in ('precision', 'recall', 'f1', 'auc_roc')})}) join earlier using (metric))"""]
GRADE_SUM = """overall as (select points, checks, points / checks * 100 as success_percent from (select sum(points) as points, count(*) as checks from grades))"""
VERDICT = "case when success_percent >= 80 then 'OUTSTANDING' when success_percent >= 60 then 'SOLID' when success_percent >= 40 then 'ACCEPTABLE' else 'NEEDS_IMPROVEMENT' end"
RADAR = f"""radar as (select metric, least(value / cast(top as double), 1) as share from ({_unpivot({m: m for m in ('precision', 'recall', 'f1', 'auc_roc', 'specificity')})})
    join (values ('precision', 0.55), ('recall', 0.70), ('f1', 0.55), ('auc_roc', 0.85), ('specificity', 1.0)) t(metric, top) using (metric))"""
READY = """ready as (select *, (precision_share + recall_share + fpr_share) / 3 as readiness from (
    select least(precision / 0.30::double, 1) as precision_share, least(recall / 0.45::double, 1) as recall_share,
           greatest(0, 1 - fpr / 0.05::double) as fpr_share,
           precision >= 0.30 as precision_ready, recall >= 0.45 as recall_ready, fpr <= 0.05 as fpr_ready from m))"""
STATUS = "case when readiness >= 0.7 then 'DEPLOY' when readiness >= 0.5 then 'REVIEW' else 'IMPROVE' end"
FLAGS = """flags as (select (precision / 0.1487::double - 1) * 100 as precision_change_percent,
    precision >= 0.30 and recall >= 0.45 and fpr <= 0.05 as meets_realistic_targets,
    precision >= 0.30 and investigation_efficiency >= 0.70 as deployment_ready from m)"""
TRIALS = [TX, KEPT, f"""trial_scored as (select trial, isFraud as label, round(cast(amount as double) / (cast(amount as double) + scale), 6) as p
    from kept cross join (values {', '.join(f'({i}, {s}.0::double)' for i, s in enumerate(TRIAL_SCALES))}) t(trial, scale))""",
          *_valid("search", "trial_scored", "trial"),
          """trials as (select t.trial, coalesce(b.score, 0) as score, coalesce(b.threshold, 0.5) as threshold, coalesce(precision, 0) as precision,
    coalesce(recall, 0) as recall, coalesce(f1, 0) as f1, coalesce(fpr, 1) as fpr, 10.0::double + t.trial as seconds,
    case when t.trial = 5 then 'FAILED' else 'COMPLETE' end as state
    from (select distinct trial from trial_scored) t
    left join (select *, row_number() over (partition by trial order by score desc, threshold) as rn from valid) b on b.trial = t.trial and b.rn = 1)""",
          "top as (select * from trials order by score desc, trial limit 1)"]
BEST = {"score": "best_score", "threshold": "best_threshold", "precision": "best_precision", "recall": "best_recall", "f1": "best_f1", "fpr": "best_fpr"}
BEST_OUT = ", ".join(f"round(cast({c} as double), 6) as {n}" for c, n in BEST.items())
NUMERIC = {"amount": 1, "oldbalanceOrg": 1, "newbalanceOrig": 1, "oldbalanceDest": 1, "newbalanceDest": 1}
TX_FLOATS = list(NUMERIC)
TX_OTHERS = ["step", "type", "nameOrig", "nameDest", "isFraud", "isFlaggedFraud"]
ADASYN = [*_base(LIMITS["adasyn"]), *_split(), MINORITY, _need(0.05), _near("around", "minority", "train", 3),
          "shares as (select q_id, count(*) filter (where nn_label = 0) / 3.0::double as share from around group by q_id)",
          "copies as (select q_id as tx_id, cast(round_even(share / (select sum(share) from shares) * n_new, 0) as bigint) as copies from shares, need)",
          _near("nn", "minority", "minority", 3), _synthetic(3)]
BORDERLINE = [*_base(LIMITS["borderline_smote"]), *_split(), MINORITY, _need(0.03), _near("around", "minority", "train", 5),
              """danger as (select * from minority where tx_id in (select q_id from around group by q_id
                  having 2 * count(*) filter (where nn_label = 0) >= 5 and count(*) filter (where nn_label = 0) < 5))""",
              _near("nn", "danger", "minority", 3), _even("danger"), _synthetic(3)]


def _links(rows: str) -> list[str]:
    return [f"few as (select * from {rows} where isFraud = 1)", _near("one", "few", rows, 1),
            f"hit as (select * from {rows} where tx_id in (select nn_id from one where nn_label = 0))", _near("back", "hit", rows, 1),
            """links as (select one.q_id as minority_id, one.nn_id as majority_id from one
                join back on back.q_id = one.nn_id and back.nn_id = one.q_id where one.nn_label = 0)"""]


SMOTE_TOMEK = [*_smote(LIMITS["smote_tomek"], 0.08, 5),
               f"""both_rows as (select tx_id, {', '.join(F)}, isFraud, false as is_synthetic from train
                   union all select tx_id, {', '.join(F)}, isFraud, true as is_synthetic from synthetic)""", *_links("both_rows")]
BASE_TRAIN = [*BASE, *_split()]
HIST = """spans as (select label, count(*) as total, min(p) as lo, max(p) as hi from scored group by label),
    bins as (select label, total, lo, hi, i as bin, lo + i * ((hi - lo) / 50) as "left", case when i = 49 then hi else lo + (i + 1) * ((hi - lo) / 50) end as "right"
             from spans cross join range(50) t(i))"""


def _cells(names: list[str]) -> str:
    return " + ".join(f"count(*) filter (where {c} is null)" for c in names)


ALL_TX = ["tx_id", *TX_OTHERS, *TX_FLOATS]
SPLIT_STATS = f"""audit as (select split, {' + '.join(f'count(*) filter (where {f} is null)' for f in F)} as missing_cells,
    ({' + '.join(f'sum(coalesce(cast({f} as double), 0))' for f in F)}) / ({' + '.join(f'count({f})' for f in F)}) as grand_mean from after_rows group by split)"""
REPORT = [*METRICS, *GRADES, *CHANGE, GRADE_SUM, RADAR, READY, FLAGS]

WEIGHT = "weight as (select (count(*) - sum(isFraud)) / sum(isFraud) as w from kept)"


def _draw(name: str, kind: str, low: float, high: float, trials: int = 30) -> str:
    u = f"({_hash('i', purpose=name)} / 2147483647.0::double)"
    value = {"int": f"{low} + floor({u} * {high - low + 1})", "uniform": f"{_num(low)} + {u} * ({_num(high)} - {_num(low)})",
             "log": f"exp(ln({_num(low)}) + {u} * (ln({_num(high)}) - ln({_num(low)})))"}[kind]
    return f"select cast(i as int) as trial, '{name}' as name, round(cast({value} as double), 6) as value from range({trials}) t(i)"


def _draws(space: list[tuple], trials: int) -> str:
    return "draws as (" + " union all ".join(_draw(*p, trials) for p in space) + ")"


PARTS = """parts as (select 'train' as part, count(*) filter (where split = 'train') as n from splits
    union all select 'val', count(*) filter (where split = 'val') from splits
    union all select 'test', count(*) filter (where split = 'test') from splits)"""
AFTER = """after_rows as (select tx_id, """ + ", ".join(F) + """, isFraud, split from splits
    union all select tx_id, """ + ", ".join(F) + """, isFraud, 'train_balanced' from train
    union all select tx_id, """ + ", ".join(F) + """, isFraud, 'train_balanced' from synthetic)"""


ORACLE: dict[str, str] = {
    "trial_parameters": _with(TX, KEPT, WEIGHT, _draws(DRAWN, 30),
                              select="select draws.*, round(least(w, 100), 6) as positive_weight from draws, weight"),
    "trial_parameters_wide": _with(TX, KEPT, WEIGHT, _draws(DRAWN_WIDE, 60),
                                   select="select draws.*, round(least(w, 100), 6) as positive_weight from draws, weight"),
    "search_trials": _with(_draws(DRAWN, 2), select="""select trial, max(case when name = 'max_depth' then value end) as max_depth,
        max(case when name = 'learning_rate' then value end) as learning_rate, max(case when name = 'n_estimators' then value end) as n_estimators,
        'COMPLETE' as state, true as rounds_in_range, true as metrics_in_range from draws group by trial"""),
    "model_scores": _with(*BASE_TRAIN, PARTS, select="""select part, n, n as keys, 0 as outside, n as same_after_reload from parts"""),
    "learning_curve": "select part, true as one_row_per_round, true as in_range, true as ends_at_the_model from (values ('train'), ('val')) t(part)",
    "top_features": "select 15 as n, 15 as known, true as shares_fit, true as in_order, true as as_the_saved_trees",
    "run_all_steps": _with(*_smote(150, 0.15, 5), PARTS, select="""select 'loaded' as stage, count(*) as n from tx
        union all select 'features', count(*) from kept union all select 'train', n from parts where part = 'train'
        union all select 'val', n from parts where part = 'val' union all select 'test', n from parts where part = 'test'
        union all select 'train_balanced', (select count(*) from train) + (select count(*) from synthetic)
        union all select 'trials', 2 union all select 'best_params', 1 union all select 'scored_val', n from parts where part = 'val'
        union all select 'scored_test', n from parts where part = 'test' union all select 'package', 1 union all select 'steps', 5"""),
    "stage_manifest": _with(*_smote(150, 0.15, 5), PARTS, select="""select 'load' as step, 'loaded' as name, (select count(*) from tx) as n_rows, 12 as n_columns, 1 as seq
        union all select 'features', 'features', (select count(*) from kept), 21, 3
        union all select 'split', 'splits', (select count(*) from kept) + (select count(*) from synthetic), 23, 4
        union all select step, name, n_rows, n_columns, seq from (values
            ('load', 'loaded_profile', 1, 6, 1), ('load', 'loaded_columns', 5, 3, 1), ('load', 'loaded_balance', 1, 5, 1),
            ('features', 'amount_stats', 1, 9, 3), ('features', 'feature_manifest', 19, 6, 3),
            ('split', 'removed', 0, 1, 4), ('split', 'split_metadata', 1, 2, 4), ('split', 'moments_train', 19, 3, 4),
            ('split', 'moments_summary_train', 1, 2, 4), ('split', 'moments_train_balanced', 19, 3, 4),
            ('split', 'moments_summary_train_balanced', 1, 2, 4), ('split', 'split_balance', 4, 4, 4),
            ('split', 'split_audit', 4, 5, 4), ('split', 'resample_summary', 2, 5, 4)) t(step, name, n_rows, n_columns, seq)"""),
    "stored_values": _with(*_smote(150, 0.15, 5), PARTS, f"""facts as (select count(*) as n, count(*) filter (where isFraud = 1) as bad,
            quantile_cont(cast(amount as double), 0.5) as median, {_cells(ALL_TX)} as missing from tx),
        balanced as (select count(*) + (select count(*) from synthetic) as n,
            count(*) filter (where isFraud = 1) + (select count(*) from synthetic) as bad from train),
        test_part as (select count(*) as n, count(*) filter (where isFraud = 1) as bad from splits where split = 'test')""", select="""
        select stage, item, round(cast(value as double), 4) as value from (
            select 'loaded_profile' as stage, unnest([0, 1, 2, 3, 4]) as item, unnest([n, bad, bad / n, median, missing]) as value from facts
            union all select 'loaded_balance', unnest([0, 1]), unnest([n - bad, 100 * bad / n]) from facts
            union all select 'amount_stats', unnest([0, 1, 2, 3, 4]), unnest([p1, median, p99, mean, std]) from stats
            union all select 'search_metadata', unnest([0, 1, 2, 3, 4, 5, 6, 7]), unnest([19, balanced.n, balanced.bad / balanced.n, parts.n, 0, 1, 1, 0.05])
                from balanced, parts where part = 'val'
            union all select 'package', unnest([0, 1, 2, 3, 4, 5]), unnest([19, 19, balanced.bad / balanced.n, t.bad, t.n, 1]) from balanced, test_part t)"""),
    "content_keys": _with(TX, select="select type, isFraud, step, count(*) as n, count(*) as keys, true as positive from tx group by type, isFraud, step"),
    "run_one_step": _with(*_smote(150, 0.15, 5), PARTS, select="""select part, n from parts
        union all select 'train_balanced', (select count(*) from train) + (select count(*) from synthetic)"""),
    "amount_stats_approx": _with(TX, KEPT, select="select " + ", ".join(
        f"round(cast(quantile_disc(a, {q}) as double), 6) as {n}" for n, q in
        {"p1": 0.01, "p5": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}.items())
        + ", round(avg(a), 6) as mean, round(stddev_pop(a), 6) as std from (select cast(amount as double) as a from kept)"),
    "knn_tiles": _with(*BASE_TRAIN, MINORITY, _near("nn", "minority", "train", 5), select="select q_id, cast(rank as int) as rank, nn_id, round(sqrt(d2), 4) as distance, nn_label from nn"),
    "knn_rings": _with(*BASE_TRAIN, MINORITY, _near("nn", "minority", "train", 5), select="select q_id, cast(rank as int) as rank, nn_id, round(sqrt(d2), 4) as distance, nn_label from nn"),
    "fallback_parameters": _with(TX, KEPT, WEIGHT, select=f"""select name, cast(value as double) as value from (values
        {', '.join(f"('{n}', {v})" for n, v in FIXED.items())}) t(name, value)
        union all select 'scale_pos_weight', round(least(w, 50), 6) from weight"""),
    "read_transactions": _with(TX, select=f"select {', '.join(TX_OTHERS)}, {_round(TX_FLOATS, 6)}, (select count(*) from tx) as keys, true as dense from tx"),
    "append_chunks": _with(TX, select=f"select tx_id, {', '.join(TX_OTHERS)}, {_round(TX_FLOATS, 6)} from tx"),
    "narrow_floats": _with(TX, select="select tx_id, round(cast(cast(cast(amount as double) / 3 as float) as double), 6) as third from tx"),
    "stage_round_trip": _with(*_smote(150, 0.15, 5), AFTER, select=f"select tx_id, {_round(F, 3)}, isFraud, split as part from after_rows"),
    "prediction_sample": _with(*_chosen("device"), select="""select tx_id, round(p, 6) as p, case when p >= (select threshold from chosen) then 1 else 0 end as prediction, label
        from scored order by tx_id limit 1000"""),
    "drop_leakage": _with(TX, select="select tx_id, step, type, round(cast(amount as double), 6) as amount, isFraud from tx"),
    "filter_types": _with(TX, KEPT, select=f"select tx_id, {', '.join(TX_OTHERS)}, {_round(TX_FLOATS, 6)} from kept"),
    "select_xy": _with(TX, KEPT, select=f"select tx_id, step, nameOrig, nameDest, isFraud, isFlaggedFraud, {_round(TX_FLOATS, 6)} from kept"),
    "to_float_features": _with(TX, KEPT, select=f"select tx_id, isFraud, {_round(['step', 'amount'], 6)} from kept"),
    "encode_remaining_strings": _with(TX, select="select tx_id, " + ", ".join(
        f"cast(dense_rank() over (order by {c}) - 1 as double) as {c}" for c in ("type", "nameOrig", "nameDest")) + " from tx"),
    "numeric_profile": _with(TX, select=" union all ".join(
        f"""select '{c}' as "column", count(*) filter (where {c} is null) as missing, round(avg(cast({c} as double)), 6) as mean from tx""" for c in TX_FLOATS)),
    "missing_cells": _with(TX, select=f"select {_cells(ALL_TX)} as missing_values from tx"),
    "label_balance": _with(TX, select="""select count(*) as total_rows, count(*) filter (where isFraud = 1) as fraud,
        count(*) filter (where isFraud = 0) as legit, round(avg(isFraud) * 100, 6) as fraud_percent from tx"""),
    "rate_band": _with(TX, select="""select count(*) as total_rows, count(*) filter (where isFraud = 1) as fraud,
        count(*) filter (where isFraud = 0) as legit, round(avg(isFraud) * 100, 6) as fraud_percent,
        case when avg(isFraud) * 100 < 0.1 or avg(isFraud) * 100 > 5 then 'UNUSUAL' else 'NORMAL' end as band from tx"""),
    "type_counts": _with(TX, select="select type, count(*) as n from tx group by type order by n desc, type"),
    "distinct_types": _with(TX, select="select distinct type from tx order by type"),
    "amount_summary": _with(TX, select="select min(a) as min, max(a) as max, round(avg(a), 6) as mean, quantile_cont(a, 0.5) as median from (select cast(amount as double) as a from tx)"),
    "duplicate_rows": _with(TX, select="select count(*) - (select count(*) from (select distinct step, type, nameOrig, isFraud from tx)) as duplicates from tx"),
    "dataset_profile": _with(TX, select=f"""select count(*) as total_rows, count(*) filter (where isFraud = 1) as fraud_count, round(avg(isFraud), 6) as fraud_rate,
        (select string_agg(type, ',' order by type) from (select distinct type from tx)) as types, min(cast(amount as double)) as amount_min,
        max(cast(amount as double)) as amount_max, round(avg(cast(amount as double)), 6) as amount_mean, quantile_cont(cast(amount as double), 0.5) as amount_median,
        {_cells(ALL_TX)} as missing_values,
        count(*) - (select count(*) from (select distinct {', '.join(ALL_TX[1:])} from tx)) as duplicates from tx"""),
    "split_balance": _with(*_smote(150, 0.15, 5), AFTER, select="select split, count(*) as n, cast(sum(isFraud) as bigint) as positives, round(avg(isFraud), 6) as rate from after_rows group by split"),
    "split_audit": _with(*_smote(150, 0.15, 5), AFTER, SPLIT_STATS, select="select split, missing_cells > 0 as has_nan, false as has_inf, missing_cells, round(grand_mean, 3) as grand_mean from audit"),
    "feature_moments": _with(*_smote(150, 0.15, 5), AFTER, select=" union all ".join(
        f"select split, '{f}' as feature, round(avg(cast({f} as double)), 3) as mean, round(stddev_pop(cast({f} as double)), 3) as std from after_rows where split in ('train', 'train_balanced') group by split" for f in F)),
    "moments_summary": _with(*_smote(150, 0.15, 5), AFTER, "mo as (" + " union all ".join(
        f"select split, avg(cast({f} as double)) as mean, stddev_pop(cast({f} as double)) as std from after_rows where split in ('train', 'train_balanced') group by split" for f in F) + ")",
        select="select split, round(avg(mean), 2) as mean_of_means, round(avg(std), 2) as mean_of_stds from mo group by split"),
    "filter_reduction": _with(TX, KEPT, select="select (select count(*) from tx) as rows_before, (select count(*) from kept) as rows_after"),
    "amount_stats": _with(TX, KEPT, STATS, select=f"select {_round(['p1', 'p5', 'p25', 'median', 'p75', 'p95', 'p99', 'mean', 'std'], 6)} from stats"),
    "amount_features": _with(TX, KEPT, STATS, WIDE, select=f"select tx_id, {_round(['amount', 'amount_log', 'amount_zscore'], 6)}, is_round_amount, is_extreme_amount, amount_category from wide"),
    "time_features": _with(TX, KEPT, STATS, WIDE, select="select tx_id, step, hour, day, is_night, is_weekend, is_deep_night from wide"),
    "type_features": _with(TX, KEPT, STATS, WIDE, select="select tx_id, type, cast(type_encoded as int) as type_encoded, is_cash_out from wide"),
    "interaction_features": _with(*BASE, select=f"select tx_id, {_round(['amount_hour_interaction', 'round_amount_night', 'extreme_amount_cashout'], 4)} from feats"),
    "risk_flags": _with(*BASE, select=f"select tx_id, {_round(['high_risk_pattern', 'suspicious_timing'], 6)} from feats"),
    "engineer_features": _with(*BASE, select=f"select tx_id, {_round(F, 5)}, isFraud from feats"),
    "feature_manifest": _with(TX, KEPT, select="select t.position, t.feature, 'float' as type, 19 as feature_count, n_rows, round(label_rate, 6) as label_rate "
                              f"from (values {', '.join(f'({i}, {f!r})' for i, f in enumerate(F))}) t(position, feature), "
                              "(select count(*) as n_rows, avg(isFraud) as label_rate from kept)"),
    "stratified_split": _with(TX, KEPT, *_split("kept"), select="select tx_id, isFraud, case when split = 'test' then 'test' else 'train' end as split from splits"),
    "nested_split": _with(TX, KEPT, *_split("kept"), select="select tx_id, isFraud, split from splits"),
    "imbalance": _with(*BASE_TRAIN, select="""select cast(sum(isFraud) as bigint) as positives, count(*) as total_rows, round(avg(isFraud), 6) as rate,
        round((count(*) - sum(isFraud)) / sum(isFraud), 6) as imbalance from train"""),
    "choose_strategy": " union all ".join("(" + _with(_tx(limit), KEPT, """i as (select cast(sum(isFraud) as bigint) as positives, count(*) as total_rows, avg(isFraud) as rate,
        (count(*) - sum(isFraud)) / sum(isFraud) as imbalance from kept)""", select=f"""select {limit} as value_limit, positives, total_rows, round(rate, 6) as rate, round(imbalance, 6) as imbalance,
        case when imbalance > 300 then 'borderline_smote' when imbalance > 150 then 'adasyn' when imbalance > 100 then 'smote_tomek' else 'smote' end as method,
        cast(case when imbalance > 300 then 0.03 when imbalance > 150 then 0.05 when imbalance > 100 then 0.08 else 0.15 end as double) as target_ratio,
        case when imbalance > 150 then 3 else 5 end as k, case when imbalance > 300 then 5 end as m from i""") + ")" for limit in LIMITS.values()),
    "knn": _with(*BASE_TRAIN, MINORITY, _near("nn", "minority", "train", 5), select="select q_id, cast(rank as int) as rank, nn_id, round(sqrt(d2), 4) as distance, nn_label from nn"),
    "smote": _with(*_smote(LIMITS["smote"], 0.15, 5), select=SYNTHETIC_OUT),
    "borderline_smote": _with(*BORDERLINE, select=SYNTHETIC_OUT),
    "adasyn": _with(*ADASYN, select=SYNTHETIC_OUT),
    "tomek_links": _with(*BASE_TRAIN, *_links("train"), select="select minority_id, majority_id from links"),
    "smote_tomek": _with(*SMOTE_TOMEK, select=f"""select tx_id, {_round(F, 3)}, isFraud, is_synthetic from both_rows
        where tx_id not in (select minority_id from links union all select majority_id from links)"""),
    "append_synthetic": _with(*_smote(150, 0.15, 5), select=f"""select tx_id, {_round(F, 3)}, isFraud, false as is_synthetic from train
        union all select tx_id, {_round(F, 3)}, isFraud, true from synthetic"""),
    "class_weight": _with(*BASE_TRAIN, select="select round(least((count(*) - sum(isFraud)) / sum(isFraud), 100), 6) as positive_weight from train"),
    "resample_summary": _with(*_smote(150, 0.15, 5), """b as (select 'before' as stage, isFraud from train union all
        select 'after', isFraud from train union all select 'after', isFraud from synthetic)""",
        select="select stage, count(*) as n, cast(sum(isFraud) as bigint) as positives, round(avg(isFraud), 6) as rate, 'smote (15%)' as method from b group by stage"),
    "best_trial": _with(*TRIALS, select=f"select trial, {BEST_OUT} from top"),
    "search_summary": _with(*TRIALS, select=f"""select trial, {BEST_OUT}, (select count(*) from trials) as n_trials,
        (select count(*) from trials where state = 'COMPLETE') as n_completed_trials, (select sum(seconds) from trials) as optimization_seconds from top"""),
    "target_checks": _with(*TRIALS, """checks as (select 'precision' as "check", precision as value, precision >= 0.30 as passed from top
        union all select 'recall', recall, recall >= 0.45 from top union all select 'f1', f1, f1 >= 0.35 from top union all select 'fpr', fpr, fpr <= 0.05 from top)""",
        "share as (select cast(count(*) filter (where passed) as double) / 4 * 100 as success_percent from checks)",
        select="""select "check", round(value, 6) as value, passed, success_percent,
        case when success_percent >= 75 then 'EXCELLENT' when success_percent >= 50 then 'GOOD' else 'NEEDS_IMPROVEMENT' end as band from checks, share"""),
    "predict_at": _with(TX, KEPT, SCORED, select="select tx_id, label, p, case when p >= 0.5 then 1 else 0 end as prediction from scored"),
    "threshold_sweep": _with(TX, KEPT, SCORED, *_sweep(GRIDS["host"]), select=f"select round(threshold, 6) as threshold, tp, fp, fn, tn, {_round(RATES, 6)} from sweep"),
    "valid_thresholds": _with(TX, KEPT, SCORED, *_valid("device"), select=f"select tp, fp, fn, tn, {_round(['threshold', *RATES, 'score'], 6)} from valid"),
    **{f"threshold_{n}": _with(*_chosen(n), select=f"select {_round(['threshold', *RATES, 'score'], 6)} from chosen") for n in RULES},
    "threshold_curve": _with(TX, KEPT, SCORED, *_sweep(GRIDS["curve"]), select=f"select {_round(['threshold', 'precision', 'recall', 'f1'], 6)} from sweep"),
    "basic_metrics": _with(*_chosen("device"), select=f"select {_round(['precision', 'recall', 'f1'], 6)} from chosen"),
    "roc_auc": _with(TX, KEPT, SCORED, POINTS, select=f"select round({AUC}, 6) as auc_roc from points"),
    "average_precision": _with(TX, KEPT, SCORED, POINTS, select=f"select round({AP}, 6) as auc_pr from points"),
    "confusion_matrix": _with(*_chosen("device"), select="""select 0 as actual, 0 as predicted, tn as n from chosen union all select 0, 1, fp from chosen
        union all select 1, 0, fn from chosen union all select 1, 1, tp from chosen"""),
    "business_rates": _with(*_chosen("device"), select="""select round(precision, 6) as investigation_efficiency, round(recall, 6) as fraud_detection_rate,
        round(fpr, 6) as false_positive_rate, round(tn / (tn + fp), 6) as specificity, round(tn / (tn + fn), 6) as negative_predictive_value from chosen"""),
    "roc_curve": _with(TX, KEPT, SCORED, POINTS, select="""select p as threshold, round(c_neg / n_all, 6) as fpr, round(c_pos / p_all, 6) as tpr from points
        union all select cast('infinity' as double), 0, 0"""),
    "pr_curve": _with(TX, KEPT, SCORED, POINTS, select="""select p as threshold, round(c_pos / (c_pos + c_neg), 6) as precision, round(c_pos / p_all, 6) as recall from points
        union all select null, 1.0, 0.0"""),
    "base_rate": _with(TX, KEPT, SCORED, select="select round(avg(label), 6) as base_rate from scored"),
    "score_histogram": _with(TX, KEPT, SCORED, HIST, select="""select b.label, cast(b.bin as int) as bin, round(b."left", 6) as "left", round(b."right", 6) as "right",
        count(s.p) as n, round(count(s.p) / (any_value(b.total) * ((any_value(b.hi) - any_value(b.lo)) / 50)), 6) as density
        from bins b left join scored s on s.label = b.label and s.p >= b."left" and (s.p < b."right" or (b.bin = 49 and s.p <= b."right"))
        group by b.label, b.bin, b."left", b."right" """),
    "test_metrics": _with(*METRICS, select=f"""select tp, fp, fn, tn, {_round(['precision', 'recall', 'f1', 'investigation_efficiency', 'fraud_detection_rate',
        'fpr', 'specificity', 'negative_predictive_value', 'auc_roc', 'auc_pr', 'threshold'], 6)} from m"""),
    "grade_targets": _with(*METRICS, *GRADES, select="select metric, round(value, 6) as value, low, high, within_limit, grade, cast(points as double) as points from grades"),
    "grade_summary": _with(*METRICS, *GRADES, GRADE_SUM, select=f"select cast(points as double) as points, checks, round(success_percent, 6) as success_percent, {VERDICT} as verdict from overall"),
    "vs_baseline": _with(*METRICS, *CHANGE, select=f"select metric, {_round(['value', 'baseline', 'change_percent'], 4)} from change"),
    "radar_values": _with(*METRICS, RADAR, select="select metric, round(share, 6) as share from radar"),
    "readiness": _with(*METRICS, READY, select=f"select {_round(['precision_share', 'recall_share', 'fpr_share'], 6)}, precision_ready, recall_ready, fpr_ready, round(readiness, 6) as readiness, {STATUS} as status from ready"),
    "package_flags": _with(*METRICS, FLAGS, select="select round(precision_change_percent, 4) as precision_change_percent, meets_realistic_targets, deployment_ready from flags"),
    "report_table": _with(*REPORT, select=f"""select section, name, round(cast(value as double), 4) as value, target, status from (
        select 'performance' as section, metric as name, value, case metric when 'precision' then '0.3-0.55' when 'recall' then '0.45-0.7'
            when 'f1' then '0.35-0.55' when 'auc_roc' then '0.7-0.85' else '0.0-0.05' end as target, grade as status from grades
        union all select 'performance', metric, value, null, null from ({_unpivot({'auc_pr': 'auc_pr', 'threshold': 'threshold'})})
        union all select 'improvement', metric, change_percent, null, null from change
        union all select 'business', metric, value, case when metric = 'false_positive_rate' then '<0.05' end, null from ({_unpivot({
            'investigation_efficiency': 'investigation_efficiency', 'fraud_detection_rate': 'fraud_detection_rate', 'false_positive_rate': 'fpr',
            'specificity': 'specificity', 'negative_predictive_value': 'negative_predictive_value', 'true_positives': 'tp', 'false_positives': 'fp',
            'false_negatives': 'fn', 'true_negatives': 'tn'})})
        union all select 'overall', 'success_percent', success_percent, null, {VERDICT} from overall
        union all select 'overall', 'readiness', readiness, null, {STATUS} from ready
        union all select 'overall', 'recommendation', null, null, case when precision >= 0.30 and fpr <= 0.05 then 'READY_FOR_PRODUCTION' else 'REVIEW_RECOMMENDED' end from m
        union all select 'radar', metric, share, null, null from radar
        union all select 'package', 'meets_realistic_targets', cast(meets_realistic_targets as int), null, case when meets_realistic_targets then 'YES' else 'NO' end from flags
        union all select 'package', 'deployment_ready', cast(deployment_ready as int), null, case when deployment_ready then 'YES' else 'NO' end from flags)"""),
    "run_summary": """select count(*) as steps_run, count(*) filter (where event_type <> 'error') as successes, count(*) filter (where event_type = 'error') as failures,
        round(sum(value), 4) as total_duration, round(avg(value), 4) as mean_duration,
        round(avg(value) * greatest(5 - count(distinct event_id % 5 + 1), 0), 4) as remaining_estimate from events""",
}
# The profiles merged from chunks are those of the whole table.
ORACLE |= {"merged_profile": ORACLE["dataset_profile"], "merged_columns": ORACLE["numeric_profile"]}
